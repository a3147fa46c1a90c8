"""Line spread, chunk de-duplication, near-duplicates."""

import collections
import random
import sys
from pathlib import Path

import pytest
from samples import prose

from daymart.llm import chunk_dedup, line_spread, minhash_join

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


# ---- lines ------------------------------------------------------------------------------


def test_lines_on_many_sites_go(make):
    line = "read more of this here"
    rows = [(i, f"{prose(i)}\n  {line} \n{prose(i + 500)}", "en", f"s{i % 9}") for i in range(18)]
    rows += [(100 + i, f"{prose(100 + i)}\nonly on one site of all\nyes", "en", "s1") for i in range(12)]
    rows += [(200 + i, prose(3007) + "\n" + prose(3008), "en", f"s{i}") for i in range(9)]  # copies stay
    out = {r["doc_id"]: r for r in line_spread.cleaned(make(rows), report=True).collect()}
    for i, text, *_ in rows:
        want = text.replace(f"  {line} \n", "") if i < 100 else text
        assert out[i]["text"] == want and out[i]["n_removed"] == (i < 100)


def test_sketch_and_exact_counts_agree_at_the_threshold(make):
    rows = [(k * 100 + i, f"line number {k} of all\n{prose(k * 100 + i)}", "en", f"s{i}") for k in range(4, 13) for i in range(k)]
    found = line_spread.spread_lines(line_spread.lines_of(make(rows), "doc_id", "text", "source", 3), 8)
    assert sorted(r["sites"] for r in found.collect()) == [8, 9, 10, 11, 12]


def test_lines_of_messy_rows(make, messy):
    docs = make(messy)
    out = line_spread.cleaned(docs, min_sites=1, min_words=1)
    assert out.columns == docs.columns
    # Every line is spread over one site, so every document is mostly spread lines and stays.
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(map(str, (r[1] for r in messy)))
    assert line_spread.cleaned(docs.filter("false")).count() == 0


# ---- chunks -----------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "a", "ü" * 3000, prose(3, 900), "x" * 1000 + " " + prose(4), " \n " * 400, "wort " * 3000])
def test_chunks_cover_the_text(text):
    raw, at = text.encode(), 0
    for start, size, _, _ in chunk_dedup.chunks(text):
        assert start == at and 0 < size <= chunk_dedup.MAX
        raw[start : start + size].decode()
        at += size
    assert at == len(raw)


def test_rolling_hash_has_a_window_of_sixteen_bytes():
    import numpy as np

    data = np.frombuffer(prose(5, 300).encode(), np.uint8)
    fast = chunk_dedup.rolling(data)
    for i in range(40, 400, 7):
        slow = sum(int(chunk_dedup.GEAR[data[i - k]]) << k for k in range(16)) & 0xFFFFFFFF
        assert int(fast[i]) == slow


def test_borders_resist_insertions():
    text = prose(11, 2000)
    moved = text[:300] + " inserted words " + text[300:]
    a, b = ({d for *_, d in chunk_dedup.chunks(t)} for t in (text, moved))
    assert len(a - b) <= 4


def brute_chunks(rows, min_words):
    """Digest -> smallest document; then the runs of each document."""
    cut = {i: list(chunk_dedup.chunks(t)) for i, t in rows if i is not None and t is not None}
    keeper = {}
    for i in sorted(cut):
        for *_, digest in cut[i]:
            keeper.setdefault(digest, i)
    out = {}
    for i, text in rows:
        if i is None or text is None:
            out[i] = text
            continue
        seen, gone = set(), []
        for start, size, words, digest in cut[i]:
            if keeper[digest] != i or digest in seen:
                if gone and gone[-1][1] == start:
                    gone[-1][1:] = [start + size, gone[-1][2] + words]
                else:
                    gone.append([start, start + size, words])
            seen.add(digest)
        raw, last, parts = text.encode(), 0, []
        for start, end, words in gone:
            if words >= min_words:
                parts.append(raw[last:start])
                last = end
        out[i] = (b"".join(parts) + raw[last:]).decode()
    return out


def test_passages_against_brute_force(make):
    draw = random.Random(2)
    shared = [prose(900 + k, 60) for k in range(4)]
    rows = []
    for i in range(60):
        words = prose(i, 150).split()
        at = draw.randint(0, 150)
        words[at:at] = draw.choice(shared).split() if i % 2 else []
        rows.append((i, " ".join(words)))
    rows += [(70, rows[3][1]), (71, prose(4, 40) + "\n" + prose(4, 40)), (72, "ü " * 300)]
    out = chunk_dedup.deduplicated(make([(i, t, "en", "s") for i, t in rows]), report=True).collect()
    want = brute_chunks(rows, 20)
    assert {r["doc_id"]: r["text"] for r in out} == want
    texts = dict(rows)
    for r in out:  # the spans say what went
        kept, last = "", 0
        for span in r["spans"]:
            kept += texts[r["doc_id"]][last : span["start"]]
            last = span["end"]
        assert kept + texts[r["doc_id"]][last:] == r["text"] and r["n_removed"] == len(texts[r["doc_id"]]) - len(r["text"])
    carrying = [r for r in out if r["doc_id"] < 60 and r["doc_id"] % 2]
    assert sum(r["n_removed"] > 100 for r in carrying) >= len(carrying) - 4
    assert all(r["n_removed"] == 0 for r in out if r["doc_id"] < 60 and r["doc_id"] % 2 == 0)
    assert {r["doc_id"]: r["text"] for r in out}[70] == ""


@pytest.mark.parametrize("gap", ["\t", "\r", "\x0b", "\x0c", "  ", "\r\n"])
def test_words_are_parted_by_any_white_space(gap):
    words = prose(21, 400).split()
    assert sum(n for _, _, n, _ in chunk_dedup.chunks(gap.join(words))) == len(words)
    shared, texts = gap.join(prose(22, 51).split()), [gap.join(prose(k, 80).split()) for k in range(4)]
    out = brute_chunks([(0, gap.join([texts[0], shared, texts[1]])), (1, gap.join([texts[2], shared, texts[3]]))], 20)
    assert len(gap.join([texts[2], shared, texts[3]])) - len(out[1]) > 0.5 * len(shared)
    short = gap.join(prose(23, 12).split())  # fewer than 20 words stay
    kept = [(0, gap.join([texts[0], short, texts[1]])), (1, gap.join([texts[2], short, texts[3]]))]
    assert brute_chunks(kept, 20) == dict(kept)


def signs(seed, n, letters):
    draw = random.Random(seed)
    return "".join(chr(draw.choice(letters)) for _ in range(n))


@pytest.mark.parametrize(
    "letters, n",
    [(range(0x4E00, 0x5A00), 160), (range(0x3041, 0x3097), 160), (range(0x0E01, 0x0E2F), 300), ([*range(65, 91), *range(97, 123)], 900)],
)
def test_passages_of_text_without_white_space(make, letters, n):
    shared = signs(1, n, letters)
    rows = [(i, signs(100 + i, 400 + 37 * i, letters) + shared + signs(200 + i, 500, letters), "en", "s") for i in range(8)]
    out = {r["doc_id"]: r for r in chunk_dedup.deduplicated(make(rows), report=True).collect()}
    for i, text, *_ in rows:
        assert out[i]["n_removed"] == 0 if i == 0 else 0.6 * n < out[i]["n_removed"] <= n
        assert {c for c in text} >= {c for c in out[i]["text"]} and out[i]["text"] == brute_chunks([r[:2] for r in rows], 20)[i]


def test_borders_without_white_space_resist_insertions():
    for letters in (range(0x4E00, 0x5A00), range(97, 123)):
        text = signs(3, 6000, letters)
        a, b = ({d for *_, d in chunk_dedup.chunks(t)} for t in (text, text[:900] + signs(4, 7, letters) + text[900:]))
        assert len(a - b) <= 4 and len(a) > 100
    # Of a pattern that repeats, the same phase is cut whatever stands before.
    pattern = "abcdefghijklmnopqrstuvwxyz" * 200
    a, b = ({d for *_, d in chunk_dedup.chunks(t)} for t in (pattern, "0123456" + pattern))
    assert len(a - b) <= 2
    # No chunk starts with a combining mark.
    thai = "".join(chr(0x0E01 + c % 40) + "\u0e34" * (c % 2) + "\u0e49" * (c % 3 == 0) for c in random.Random(5).choices(range(200), k=3000))
    for start, *_ in chunk_dedup.chunks(thai):
        assert thai.encode()[start:].decode()[0] not in "\u0e34\u0e49"


def test_chunks_of_messy_rows(make, messy):
    docs = make(messy)
    out = chunk_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in out.collect() if r["doc_id"] != 9)
    want = sorted((str(i), "" if i == 8 else t) for i, t, *_ in messy if i != 9)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert chunk_dedup.deduplicated(docs.filter("false"), report=True).count() == 0


# ---- near-duplicates ----------------------------------------------------------------------


def brute_groups(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def family(base, n, seed, most):
    """Copies of a text with up to ``most`` words changed."""
    draw = random.Random(seed)
    for _ in range(n):
        words = base.split()
        for _ in range(draw.randint(0, most)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_against_brute_force(make, monkeypatch, block):
    monkeypatch.setattr(minhash_join, "BLOCK_ROWS", block)
    texts = [prose(k, 80) for k in range(30)]
    texts += [t for k in range(6) for t in family(prose(40 + k, 120), 12, k, 6)]
    texts += ["Ab cd", "ab CD", "x", "X", "", " ", None, "ab cd ef", prose(3, 80)]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    out = minhash_join.grouped(make([(i, t, "en", "s") for i, t in rows]), size=3, percent=85).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out}
    assert got == brute_groups(rows, 3, 85)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 302), (299, 302)]
    random.Random(1).shuffle(edges)
    out = minhash_join.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {300: 299, 301: 299, 302: 299}
    assert {r["id"]: r["component"] for r in out} == want


def test_near_duplicates_of_messy_rows(make, messy):
    docs = make(messy)
    out = minhash_join.unique_documents(docs)
    assert out.columns == docs.columns
    # 8 copies 1; the two rows of 6 are one document; a document without id stays.
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "3", "4", "5", "6", "6", "9", "None"]
    rows = {str(r["doc_id"]): r for r in minhash_join.grouped(docs).collect()}
    assert rows["None"]["component_id"] is None and rows["None"]["kept"] and rows["8"]["component_id"] == 1
    assert minhash_join.grouped(docs.filter("false")).count() == 0


def test_posting_lists_are_cut_by_frequency():
    matches = minhash_join.least_matches(85)
    assert 0.6 * minhash_join.COORDINATES < matches < 0.85 * minhash_join.COORDINATES
    counts = collections.Counter()
    for seed in range(300):  # estimated agreement stays above the threshold
        base = prose(seed, 200)
        words = base.split()
        words[100] = "changed"
        a, b = (minhash_join.shingle_set(t, 3) for t in (base, " ".join(words)))
        counts[int((minhash_join.signature(a) == minhash_join.signature(b)).sum() >= matches)] += 1
    assert counts[0] == 0


def _two_texts():
    """Ids over two texts, with multi-byte characters, shared passages and near copies."""
    shared = prose(801, 60) + " " + "größer " * 30
    a, b, c = (prose(810 + k, 120) for k in range(3))
    return [
        (1, "ü" * 40 + " " + a + " " + shared), (2, "日本 " + b + " " + shared), (2, "ß " * 99 + shared + " " + c), (3, shared + " é " + c),
        (4, a), (4, b), (5, b), (5, b), (6, a + " extra"), (4, ""), (4, None),
    ]


def test_passages_of_ids_over_two_texts(make):
    rows = _two_texts()
    out = chunk_dedup.deduplicated(make([(i, t, "en", "s") for i, t in rows]), report=True).collect()
    cut = [list(chunk_dedup.chunks(t)) for _, t in rows]
    keeper = {}
    for (i, t), own in sorted(zip(rows, cut), key=lambda x: x[0][0]):
        for *_, digest in own:
            keeper.setdefault(digest, i)
    want = []
    for (i, text), own in zip(rows, cut):
        seen, gone = set(), []
        for start, size, words, digest in own:
            if keeper[digest] != i or digest in seen:
                if gone and gone[-1][1] == start:
                    gone[-1][1:] = [start + size, gone[-1][2] + words]
                else:
                    gone.append([start, start + size, words])
            seen.add(digest)
        raw = (text or "").encode()
        for start, end, words in reversed(gone):
            raw = raw[:start] + raw[end:] if words >= 20 else raw
        want.append((i, text if text is None else raw.decode()))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out))) == sorted(map(str, want))
    assert sum(len(t or "") for _, t in want) < 0.8 * sum(len(t or "") for _, t in rows)


def test_passages_report_with_ids_of_text(spark):
    shared = prose(820, 80)
    docs = spark.createDataFrame([("a", shared), ("b", prose(821, 50) + "\n" + shared)], "doc_id string, text string")
    out = {r["doc_id"]: r for r in chunk_dedup.deduplicated(docs, report=True).collect()}
    assert out["a"]["kept_in"] == [] and out["b"]["kept_in"] == ["a"] and out["b"]["n_removed"] > 100


def test_near_duplicates_of_ids_over_two_texts(make):
    """Every row goes by its own text; nothing is lost but rows that another row stands for."""
    rows = _two_texts()
    docs = make([(i, t, "en", "s") for i, t in rows])
    sets = [set(minhash_join.shingle_set(t, 5).tolist()) for _, t in rows]
    component = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                old, new = component[x], component[y]
                component = [new if c == old else c for c in component]
    least = {c: min(i for (i, _), k in zip(rows, component) if k == c) for c in component}
    want = sorted((i, len(s), least[c], least[c] == i) for (i, _), s, c in zip(rows, sets, component))
    got = minhash_join.grouped(docs, size=5, percent=80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    left = minhash_join.unique_documents(docs, size=5, percent=80).collect()
    assert sorted((r["doc_id"], str(r["text"])) for r in left) == sorted((i, str(t)) for (i, t), c in zip(rows, component) if least[c] == i)
    assert {c for c in component} == {c for (i, _), c in zip(rows, component) if least[c] == i}  # every text has a row that stays
