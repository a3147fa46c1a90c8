"""Notices, languages, tokens, packing, fingerprints."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers.pre_tokenizers import ByteLevel
import tiktoken
from pyspark.sql import functions as F
from samples import prose
from tokenizers import Tokenizer

from daymart.llm import byte_bpe, language, notices, slack_packing, spotsigs

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = "abcT he'slrv  \t\n\r\x0b\x1c\x85\xa0é١二🙂́²Ⅷ0123!?_-​İΣς <|>"


def fuzz(seed, n, letters=ODD):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(n)]


# ---- notices ----------------------------------------------------------------------------


def brute_phrases(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c.isdigit() and c < "\x80" or "a" <= c <= "z" or c >= "\x80" else " " for c in lowered).split(" ")
    words = [w for w in words if w]
    found = []
    for phrase, label in notices.PHRASES.items():
        own = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    return len(words), found


def test_phrases_against_brute_force(make, messy):
    draw = random.Random(4)
    parts = ["CC", "by", "cc", "General", "public", "license", "all", "rights", "reserved", "x", "é", " ", "All-rights"]
    texts = [draw.choice([" ", "-", ". "]).join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(150)]
    texts += [r[1] for r in messy] + fuzz(1, 50)
    out = notices.scanned(make([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    for r in out:
        n_words, found = brute_phrases(texts[r["doc_id"]])
        assert r["n_words"] == n_words and r["n_base"] == len(found), texts[r["doc_id"]]
        assert r["first_word"] == min((k for k, _ in found), default=None)
        assert r["last_word"] == max((k for k, _ in found), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not found


def test_edited_notices_are_found_with_their_spans():
    search = notices.default_search()
    draw = random.Random(8)
    for notice, label in notices.NOTICES.items():
        for trial in range(20):
            letters = list(notice)
            for _ in range(draw.randint(0, int(len(notice) * notices.EDITS_PER_CHARACTER))):
                k = draw.randrange(1, len(letters) - 1)
                letters[k : k + draw.randint(0, 1)] = draw.choice(["q", "", "z"])
            text = f"{prose(trial, 30)}. {''.join(letters).title()}! {prose(trial + 50, 30)}"
            found = [x for x in search.find(notices.reduced(text)[0]) if x.label == label and not x.exact]
            assert found, text
            a, b = notices.character_spans(text, found[:1])[0]
            assert abs(a - text.index("".join(letters).title())) <= 12 and 0 < b - a < len(notice) + 25
    assert not search.find(notices.reduced(prose(77, 2000))[0])


def fewest_edits(notice, text):
    """The edit distance of a notice and the part of the text that is nearest to it, by the whole table."""
    above = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def test_an_edited_copy_before_cleaner_ones_is_found():
    line, n_words = notices.reduced("relaesed under the mit license and released under the mit license " * 3)
    found = sorted((x.first_word, x.edits) for x in notices.default_search().find(line) if not x.exact)
    assert n_words == 33
    assert found == [(w, e) for start in (0, 11, 22) for w, e in ((start, 2), (start + 6, 0))]


def test_edits_against_the_whole_table():
    draw, search = random.Random(6), notices.default_search()
    for notice, label in notices.NOTICES.items():
        limit = int(len(notice) * notices.EDITS_PER_CHARACTER)
        for _ in range(12):
            letters = list(notice)
            for _ in range(draw.randint(0, limit + 2)):
                letters[draw.randrange(len(letters))] = draw.choice("xyz")
            line = notices.reduced("one two " + "".join(letters) + " three four")[0]
            fewest = fewest_edits(notice, line)
            found = [x.edits for x in search.find(line) if x.label == label and not x.exact and x.score >= 1 - (limit + 0.5) / len(notice)]
            assert (min(found) == fewest) if fewest <= limit else True
            assert bool(found) >= (fewest <= limit)


def test_a_text_of_notices_only_takes_linear_time():
    line = notices.reduced("released under the mit license cc by " * 20_000)[0]
    found = notices.default_search().find(line)
    assert sum(x.exact for x in found) == 20_000
    assert sum(not x.exact and x.label == "mit" for x in found) == 20_000


# ---- languages ----------------------------------------------------------------------------


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.filter(~held), rows_per_language=200)
    rows = language.identified(docs.filter(held), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    sure = [r for r in rows if r["accepted"]]
    assert len(sure) > 0.8 * len(rows) and np.mean([r["lang_pred"] == r["lang"] for r in sure]) > 0.97


def test_subwords_and_probabilities_by_hand():
    text = "Ab, c"
    counts = dict.fromkeys(range(language.BUCKETS), 0)
    letters = [ord(c) for c in " ab  c "]
    for size in (2, 3, 4):
        for i in range(len(letters) - size + 1):
            value = 0
            for c in letters[i : i + size]:
                value = (value * 257 + c) % 2**32
            counts[value * 2654435761 % 2**32 >> 19] += 1
    assert language.subwords(text).tolist() == list(counts.values())
    draw = np.random.default_rng(1)
    model = language.Identifier(["a", "b", "c"], draw.normal(size=(language.BUCKETS, 3)), np.array([0.1, 0.0, -0.1]), 0.5)
    z = [sum(n * model.logits[k, j] for k, n in counts.items()) / sum(counts.values()) + model.bias[j] for j in range(3)]
    p = [float(np.exp(v)) / sum(float(np.exp(w)) for w in z) for v in z]
    best = max(range(3), key=p.__getitem__)
    found = model.predict(text)
    assert found[0] == "abc"[best] and abs(found[1] - p[best]) < 1e-9 and found[2] == (p[best] >= 0.5)


def test_every_labelled_language_is_learnt_and_a_repeated_text_counts_once(make):
    texts = [(f"l{k}", f"{chr(97 + k % 26)}{chr(97 + k // 26)} word {i}") for k in range(230) for i in range(2)]
    model = language.fit(make([(1, t, k, "s") for k, t in texts] + [(None, "aa word 0", "l0", "s")] * 50))
    assert model.languages == sorted({k for k, _ in texts})
    few = language.fit(make([(i, t, k, "s") for i, (k, t) in enumerate(texts)]), rows_in_all=100)
    assert 0 < len(few.languages) < 230


def test_languages_of_messy_rows(make, messy):
    docs = make(messy + [(20, "123 !?", "en", "a")])
    model = language.fit(docs)
    rows = language.identified(docs, model).collect()
    assert len(rows) == len(messy) + 1
    for r in rows:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (2, 3, 4, 20)) and 0 <= r["score"] <= 1
    nothing = language.fit(docs.filter("false"))
    assert {r["lang_pred"] for r in language.identified(docs, nothing).collect()} == {"und"}


# ---- tokens -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal():
    keys = list(byte_bpe.vocabulary(RANKS))
    table = byte_bpe.PerfectHash(keys)
    assert sorted(map(table.slot, keys)) == list(range(len(keys)))
    assert sorted(map(byte_bpe.PerfectHash([b"x"]).slot, [b"x"])) == [0]


def test_tokens_against_the_library(make, messy, reference_encoding):
    texts = [r[1] for r in messy] + fuzz(2, 400) + ["ab" * 20_000, "<|endoftext|>", prose(4, 500).title()]
    texts += fuzz(3, 200, [chr(c) for c in range(256)])
    out = byte_bpe.encoded(make([(i, t, "en", "s") for i, t in enumerate(texts)]), RANKS, public_tokenizers.PATTERN)
    for r in out.collect():
        text = texts[r["doc_id"]] or ""
        raw = np.array(reference_encoding.encode_ordinary(text), "<u4").tobytes()
        assert bytes(r["ids"]) == raw and r["n_tokens"] == len(raw) // 4
        assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in byte_bpe.decoded(out, RANKS).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


# ---- packing ------------------------------------------------------------------------------


def test_best_fill_against_brute_force():
    draw = random.Random(6)
    for _ in range(150):
        lengths = sorted({draw.randint(1, 30): draw.randint(1, 3) for _ in range(5)}.items(), reverse=True)
        space = draw.randint(1, 60)
        taken = slack_packing.best_fill(lengths, space)
        assert all(0 < c <= dict(lengths)[n] for n, c in taken)
        sums = (sum(n * c for (n, _), c in zip(lengths, counts)) for counts in itertools.product(*(range(a + 1) for _, a in lengths)))
        assert sum(n * c for n, c in taken) == max(s for s in sums if s <= space)


def ids_of(tokenize, text):
    return np.frombuffer(tokenize(text), "<u4").tolist()


def test_word_ids_against_the_library():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    own = slack_packing.WordTokenizer(WORDS)
    for text in fuzz(9, 1500) + fuzz(10, 1500, [chr(c) for c in range(128)]) + [prose(1, 300).title(), "<|endoftext|> x"]:
        assert ids_of(own, text) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("block", [8_000_000, 6_000])
def test_packing_is_whole_and_unpadded(make, messy, block):
    rows = messy + [(100 + k, prose(k, 37 * k % 900), "en", "s") for k in range(150)]
    docs = make(rows).repartition(3)
    out = slack_packing.packed(docs, WORDS, block_tokens=block).collect()
    own = slack_packing.WordTokenizer(WORDS)
    want = sorted([*ids_of(own, t), 2] for _, t, *_ in rows)
    by_document, by_sequence = {}, {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert r["length"] == len(ids) > 0 and r["ids_crc32"] == zlib.crc32(r["ids"])
        by_document.setdefault(r["doc_id"], []).append((r["start"], ids.tolist(), r["doc_tokens"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    got = []
    for key, pieces in by_document.items():
        pieces.sort()
        ids = [i for _, part, _ in pieces for i in part]
        copies = sum(r[0] == key for r in rows)
        if copies == 1:
            assert [s for s, *_ in pieces] == list(itertools.accumulate([0] + [len(p) for _, p, _ in pieces]))[:-1]
            assert all(n == len(ids) for *_, n in pieces)
            got.append(ids)
        else:
            got += [ids[: len(ids) // copies]] * 0 + [[*ids_of(own, t), 2] for k, t, *_ in rows if k == key]
            assert len(ids) == sum(len([*ids_of(own, t), 2]) for k, t, *_ in rows if k == key)
    assert sorted(got) == want
    for pieces in by_sequence.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(itertools.accumulate([0] + [n for _, n in pieces]))[:-1]
        total = sum(n for _, n in pieces)
        assert total <= 4096 and total & (total - 1) == 0  # a power of two needs no padding
    assert slack_packing.packed(docs.filter("false"), WORDS).count() == 0


# ---- fingerprints ---------------------------------------------------------------------------


def brute_spots(text):
    import regex

    words = regex.findall(r"[\p{L}\p{N}\p{M}]+", (text or "").lower())
    stops = set(spotsigs.ANCHORS)
    out = set()
    for i, word in enumerate(words):
        if word in stops:
            chain = [w for w in words[i + 1 : i + 1 + spotsigs.REACH] if w not in stops][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((word, *chain))
    if not out and words:
        out = {tuple(words[k : k + spotsigs.CHAIN]) for k in range(max(1, len(words) - spotsigs.CHAIN + 1))}
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_next_rows_edits_and_likeness(make, monkeypatch):
    texts = {k: prose(k, 5 + k * 7 % 120) for k in range(0, 900, 3)}
    texts |= {10_000: None, 10_001: "", 10_500: "a", 10**9: "The last one of all.", -5: "the first one here is small"}
    docs = make([(i, t, "en", "s") for i, t in texts.items()]).repartition(5)
    rows = spotsigs.with_next(docs).withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    for name, column in (("s", "text"), ("e", "edited"), ("n", "next_text")):
        rows = rows.withColumn(name, spotsigs.signatures(F.col(column)))
    rows = rows.withColumn("near", spotsigs.likeness(F.col("s"), F.col("e"))).withColumn("next", spotsigs.likeness(F.col("s"), F.col("n"), 0.5))
    ids = sorted(texts)
    follower = dict(zip(ids, ids[1:] + ids[:1]))
    got = rows.collect()
    assert len(got) == len(texts)
    for r in got:
        text, other = texts[r["doc_id"]] or "", texts[follower[r["doc_id"]]] or ""
        assert (r["next_text"] or "") == other
        part = len(text) // 4
        assert r["edited"] == text[: len(text) - part] + other[:part]
        assert len(r["s"]) == len(brute_spots(text))
        assert r["near"] == pytest.approx(jaccard(brute_spots(text), brute_spots(r["edited"])))
        exact = jaccard(brute_spots(text), brute_spots(other))
        assert r["next"] == pytest.approx(exact) if exact >= 0.5 else r["next"] in (0.0, pytest.approx(exact))


def test_next_rows_of_messy_rows(make, messy):
    rows = spotsigs.with_next(make(messy)).collect()
    assert len(rows) == len(messy)
    assert [r["next_text"] for r in rows if r["doc_id"] is None] == [prose(1)]
    assert [r["next_text"] for r in rows if r["doc_id"] == 9] == [prose(7)]  # NULL comes first
    assert spotsigs.with_next(make(messy).filter("false")).count() == 0


def test_near_fingerprints_against_brute_force(make):
    texts = {k: prose(k, 300) for k in range(25)}
    draw = random.Random(3)
    for k in range(25, 60):
        words = texts[k % 6].split()
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(300)] = f"word{k}"
        texts[k] = " ".join(words)
    sets = {k: brute_spots(t) for k, t in texts.items()}
    first = {}
    for k in sorted(sets):
        first.setdefault(frozenset(sets[k]), k)
    chosen = sorted(first.values())
    want = {(a, b) for a in chosen for b in chosen if a < b and jaccard(sets[a], sets[b]) >= 0.8}
    out = spotsigs.near_duplicates(make([(k, t, "en", "s") for k, t in texts.items()])).collect()
    assert {(r["a"], r["b"]) for r in out} == want and len(want) > 20


def brute_stretches(text):
    import regex

    words = regex.findall(r"[\p{L}\p{N}\p{M}]+", (text or "").lower())
    stops, out, covered = set(spotsigs.ANCHORS), set(), set()
    for i, word in enumerate(words):
        chain = [k for k in range(i + 1, min(len(words), i + 1 + spotsigs.REACH)) if words[k] not in stops][: spotsigs.CHAIN]
        if word in stops and len(chain) == spotsigs.CHAIN:
            out.add((word, *(words[k] for k in chain)))
            covered.update(range(i, chain[-1] + 1))
    if words:
        for k in range(max(1, len(words) - spotsigs.CHAIN + 1)):
            if not covered.issuperset(range(k, min(len(words), k + spotsigs.CHAIN))):
                out.add(tuple(words[k : k + spotsigs.CHAIN]))
    return out


def letters_only(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("абвгдежзиклмнопрст") for _ in range(draw.randint(3, 9))) for _ in range(n))


def test_every_stretch_without_chains_is_seen(make):
    stray = " in один два "
    texts = {k: prose(k, 1 + k * 7 % 90) for k in range(40)} | {50: None, 51: "", 52: "a", 53: "the", 54: "the a", 55: "the one two", 56: "x y"}
    texts |= {57: "the the one of two three four five six and seven", 60: letters_only(1, 200) + stray + letters_only(2, 200)}
    texts |= {61: letters_only(3, 200) + stray + letters_only(4, 200), 62: letters_only(1, 200) + " " + letters_only(2, 200)}
    rows = make([(k, t, "ru", "s") for k, t in texts.items()]).select("doc_id", spotsigs.signatures(F.col("text"), stretches=True).alias("s")).collect()
    sets = {r["doc_id"]: set(r["s"]) for r in rows}
    for k, text in texts.items():
        assert len(sets[k]) == len(brute_stretches(text)), text
    assert len(sets[60]) > 390  # grows with the text, one stray anchor or not
    assert jaccard(sets[60], sets[61]) < 0.02 and jaccard(sets[60], sets[62]) > 0.98
    pairs = spotsigs.near_duplicates(make([(k, texts[k], "ru", "s") for k in (60, 61, 62)]), stretches=True).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(60, 62)]


def test_the_query_sees_every_stretch(spark, tmp_path, make):
    from daymart.llm.queries import op9_spotsigs

    texts = [letters_only(k, 300) + " in один два " + letters_only(k + 50, 300) for k in range(3)]
    make([(k, t, "ru", "s") for k, t in enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    for r in op9_spotsigs(spark, str(tmp_path)).collect():
        assert len(r["fingerprint"]) == 10 * len(brute_stretches(texts[r["doc_id"]]))
        assert r["near_next"] < 0.02 and 0.5 < r["near_edited"] < 0.7


def test_plain_text_is_what_the_normalizer_makes():
    """Every character up to Cyrillic, alone and under combining marks, and whole texts with others."""
    tokenizer = slack_packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x21, 0x530) if not chr(c).isspace() and not 0x80 <= c < 0xA0]
    for mark in ("", "\u0301", "\u0308", "\u0327", "\u0345", "\u0323\u0302"):
        text = " ".join(f"{c}{mark} A{c}{mark} {c}{mark}A" for c in letters)
        assert not tokenizer.BEYOND(text)
        assert tokenizer.plain(text).split() == tokenizer.normalize(text).split()
    for text in ("ΑΣ ΣΑΣ", "İI ıi", "Ünïcode ẞ 日本 한국", "e\u0301 E\u0301", "ǅ ŉ ſ"):
        assert tokenizer.plain(text).split() == tokenizer.normalize(text).split()
    for part in ("é", "日", "ß\u00ad", "\x7f", "ø\x01"):
        signs = part.encode().decode("latin-1").translate(slack_packing.BYTE_SIGNS)
        assert signs == ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(part)[0][0]


def spot_members(spots):
    """The 40-bit digests of tuples of words, chained from word to word."""
    import xxhash

    out = set()
    for words in spots:
        seed = 42
        for word in words:
            seed = xxhash.xxh64_intdigest(word.encode(), seed=seed)
        out.add(f"{seed >> 24:010x}")
    return out


def test_spots_of_edited_texts_by_member(spark, make, tmp_path):
    import hashlib
    import random

    from daymart.llm.queries import op9_spotsigs

    draw = random.Random(5)
    pool = ["in", "the", "и", "ΟΔΟΣ", "é.", "a'", "x", "red", "lamp", "de", "la", "foo", "один", "two2", "\n", "ΣΑΣ.", "-"]
    texts = {}
    for k in range(120):
        size = draw.choice([0, 1, 2, 3, 5, 9, 20, 60, 400])
        kind = pool if k % 3 else pool[:3] + ["lamp"]
        texts[k] = draw.choice(["", " "]).join(draw.choice(kind) + draw.choice(["", " "]) for _ in range(size))
    texts[7], texts[50], texts[51] = None, "the red lamp " * 20_000, texts[49]
    make([(k, t, "en", "s") for k, t in texts.items()]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op9_spotsigs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for k, r in got.items():
        own, after = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        part = len(own) // 4
        new = own[: len(own) - part] + after[:part]
        sets = [spot_members(brute_stretches(t)) for t in (own, new, after)]
        assert r["fingerprint"] == "".join(sorted(sets[0])) and r["edited_fingerprint"] == "".join(sorted(sets[1])), k
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and r["n_chars"] == len(own)
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            both = len(sets[0] | other)
            assert r[name] == pytest.approx(len(sets[0] & other) / both if both else 1.0)
