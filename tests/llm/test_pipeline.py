"""The pipeline's stages against plain versions, each judged on its own input."""

import plain
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from clipwarden.llm import packing, toxicity
from clipwarden.session import scratch_path

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        texts = [(k, r.text) for k, r in before.items()]
        if name == "packing":
            got = {}
            for r in rows:
                got.setdefault(r.doc_id, []).append(r)
            assert set(got) == set(before)
            for key, text in texts:
                ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
                own = sorted(got[key], key=lambda r: r.start)
                assert [r.length for r in own] == packing.piece_lengths(len(ids))
                assert b"".join(bytes(r.ids) for r in own) == plain.u32(ids)
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in rows}
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            scores = toxicity.score(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()
            assert set(after) == {r.doc_id for r in scores if r.score < corpus_pipeline.TOXIC_AT}
            assert all(after[k] == before[k] for k in after)
        elif name == "exact_dedup":
            assert set(after) == {k for k, (keep, _) in plain.exact(texts).items() if keep == k}
        elif name == "near_dedup":
            assert set(after) == {k for k, (_, label) in plain.near(texts, 80).items() if label == k}
        else:
            want = plain.repeats(texts)
            assert set(after) == set(before)
            for key, r in after.items():
                assert plain.sha(b" ".join((r.text or "").encode().split())) == want[key][2]
                assert r.text == before[key].text or want[key][1]
                assert r.n_chars == len(r.text)
        before = after


def test_run_is_all_stages(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]


def test_stages_with_odd_rows_and_clashing_columns(spark, odd_rows, empty):
    from pyspark.sql import functions as F

    names = ["lang", "source", "key", "mark", "kept_text", "kept", "score", "best", "row", "text_a", "digest", "id"]
    rows = [*odd_rows, odd_rows[6], (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumns({n: F.lit(n) for n in names}).withColumn("n_chars", F.length("text").cast("bigint"))
    for given in (docs, docs.limit(0)):
        left = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = scratch_path(spark, name)
            stage(spark, left, "/root/testdata/sf0.001").write.parquet(path)
            left = spark.read.parquet(path)
            assert left.columns == docs.columns
        kept = {r.doc_id for r in left.collect()}
        if given is docs:  # 12 is white space only, which is not empty; 18 and 23 are near copies
            assert {10, 12, 13, 16, 20, 22} <= kept and not {11, 14, 17, 18, 23} & kept
        else:
            assert not kept


def test_rows_are_told_apart_without_ids(spark):
    """A unique text stays though its id stands on a copy as well; of rows without ids and of repeated rows one stays."""
    words = [" ".join(f"{name}{i}" for i in range(80)) for name in "abcdexy"]
    near = words[2].replace("c20", "changed")
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [
        (0, words[0]), (1, words[0]), (1, words[1]), (2, words[2]), (2, near), (None, near), (None, words[3]), (None, words[3]),
        (3, words[4]), (3, words[4]), (4, passage), (None, f"{words[5]} {passage} {words[6]}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "cast(length(text) as bigint) AS n_chars")
    left = docs.repartition(3)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        path = scratch_path(spark, name)
        stage(spark, left, "").write.parquet(path)
        left = spark.read.parquet(path)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text, r.n_chars) for r in left.collect())
    texts = {(k, t) for _, k, t, _ in got}
    # of two rows with one id the lesser text comes first
    group = min(words[2], near)
    assert texts == {(0, words[0]), (1, words[1]), (2, group), (0, words[3]), (3, words[4]), (4, passage), (0, f"{words[5]} {words[6]}")}
    assert len(got) == 7 and all(n == len(t) for _, _, t, n in got)
