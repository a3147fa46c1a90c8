"""The pipeline's stages against brute force, each on its own input."""

import collections
import os
import re

import corpus_pipeline
from samples import prose
from test_dedup import brute_chunks, brute_groups

from daymart.llm.tables import written

TRIM = re.compile("^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$")


def brute_lines(rows, min_sites=8, min_words=3, max_share=0.5):
    cut = [(i, t, s, [(x, TRIM.sub("", x), len(x.encode().split())) for x in t.split("\n")] if t is not None else []) for i, t, s in rows]
    sites = collections.defaultdict(set)
    for _, _, site, lines in cut:
        for _, bare, words in lines:
            if words >= min_words and site is not None:
                sites[bare].add(site)
    out = {}
    for i, text, _, lines in cut:
        gone = [w >= min_words and len(sites[b]) >= min_sites for _, b, w in lines]
        spread, total = sum(w for (*_, w), g in zip(lines, gone) if g), sum(w for *_, w in lines)
        out[i] = text if not any(gone) or spread > max_share * total else "\n".join(x for (x, *_), g in zip(lines, gone) if not g)
    return out


def test_every_stage_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        tables = list(corpus_pipeline._left)
        result = stage(spark, docs, folder)
        assert not any(os.path.exists(path.removeprefix("file:")) for path in tables)  # those of the stage before are gone
        assert name != "minhash_join" or corpus_pipeline._left
        if name == "slack_packing":
            lengths = collections.Counter()
            for r in result.collect():
                lengths[r["doc_id"]] += r["length"]
                assert r["doc_tokens"] >= r["start"] + r["length"]
            assert set(lengths) == set(before)
            return
        docs = written(result)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns
        assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "quality_rules":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
            good = [i for i, r in before.items() if labels.get(i) == 1 and len(r["text"].split()) >= 10]
            assert sum(i in after for i in good) >= 0.95 * len(good)
            assert sum(i in after for i, q in labels.items() if q == 0) <= 2
            assert all(after[i]["text"] == before[i]["text"] for i in after)
        if name == "line_spread":
            want = brute_lines([(i, r["text"], r["source"]) for i, r in before.items()])
            assert {i: r["text"] for i, r in after.items()} == want
        if name == "minhash_join":
            want = brute_groups([(i, r["text"]) for i, r in before.items()], 5, 80)
            assert set(after) == {i for i, (*_, kept) in want.items() if kept}
        if name == "chunk_dedup":
            assert {i: r["text"] for i, r in after.items()} == brute_chunks([(i, r["text"]) for i, r in before.items()], 20)


def test_run_on_messy_rows(spark, make, messy, tmp_path):
    rows = messy + [(50 + k, prose(50 + k), "en", f"s{k}") for k in range(20)]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {1, 5, 6, None, *range(50, 70)}
    make(rows).filter("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
