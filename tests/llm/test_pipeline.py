"""The pipeline's stages, each held against brute force on what the stage before kept."""

from __future__ import annotations

from collections import defaultdict

from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline
    from slowdigest.llm.common import staged

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, SF))
        assert n == 4 or docs.columns == columns
        kept.append(docs)
    text = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    quality, lines, near, cut = map(text, kept[:4])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert quality and all(not brute.base(t)[-1] for t in quality.values())
    good = [k for k, q in labels.items() if q == 1 and k in quality]
    assert len(good) > 10
    assert lines == brute.line_dedup(list(quality.items()))
    found = brute.jaccard_components(list(lines.items()))
    assert near == {k: lines[k] for k, (_, component) in found.items() if component == k}
    assert cut == brute.kept_first(list(near.items()))
    pieces = defaultdict(list)
    for r in kept[4].collect():
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in pieces.values():
        ends = [o + n for o, n in sorted(own)]
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert {r["doc_id"] for r in kept[4].select("doc_id").collect()} == set(cut)


def test_near_copies_judges_null_and_repeated_ids_by_text(spark):
    import corpus_pipeline

    text = lambda c: " ".join(f"{c}{n}" for n in range(40))
    rows = [
        (1, text("a")), (1, text("b")), (1, text("b")), (None, text("c")), (None, text("d")), (None, text("d") + " e"),
        (None, text("a")), (2, text("f")), (3, text("f") + " g"), (3, text("h")), (None, None), (None, ""), (5, " "),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_copies(spark, df, SF).collect()]
    either = [t for k, t in got if t in (rows[4][1], rows[5][1])]
    assert len(either) == 1
    want = [rows[n] for n in (0, 1, 3, 7, 9, 10, 11, 12)] + [(None, either[0])]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_stages_take_empty_tables_and_columns_of_any_name(spark):
    import corpus_pipeline

    kind = "doc_id long, text string, `x.y` string, row_key int, has_shingles int, component_id int, n int"
    passage = " ".join(f"w{n}" for n in range(200))
    rows = [(k, t, "v", 1, 2, 3, 4) for k, t in ((1, passage), (2, passage + " end"), (None, "own words"), (4, None))]
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, spark.createDataFrame([], kind), SF).count() == 0, name
        got = stage(spark, spark.createDataFrame(rows, kind), SF)
        assert got.columns == spark.createDataFrame(rows, kind).columns, name
        assert {tuple(r)[2:] for r in got.collect()} <= {("v", 1, 2, 3, 4)}, name
    assert corpus_pipeline.packing(spark, spark.createDataFrame([], kind), SF).count() == 0
