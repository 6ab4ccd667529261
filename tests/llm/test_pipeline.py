import hashlib
import pathlib
import re

import sentencepiece
from test_decontaminate import brute as benchmark_hits
from test_personal import slow as base_spans
from test_simhash import brute as components

import corpus_pipeline
from promptmill.llm import personal, pieces, quality


def test_pipeline_against_its_parts_done_plainly(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = [r.doc_id for r in quality.op1_quality(spark, sf).filter("predicted = 1").collect()]
    rows = sorted((i, texts[i]) for i in good)
    rows = [(i, texts[i]) for i, _, component in components(rows) if i == component]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, *_ in benchmark_hits(items, rows)}
    left = [(i, t) for i, t in rows if i not in bad]
    more = {r.doc_id: [tuple(s) for s in r.more] for r in personal.personal_data(spark.createDataFrame(left, "doc_id long, text string")).collect()}
    library, want = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()), []
    for i, t in left:
        t = personal.redact(t, [*base_spans(t), *more[i]])
        ids = library.encode(t, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert len(good) > len(rows) > len(left) > 0
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == sorted(want)


def test_stages_keep_the_columns(spark, docs, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "simhash_dedup", "decontaminate", "personal", "pieces"]
    table = docs([(1, "The and attion to thanedble the, anea. Eriner thanea."), (2, None), (None, ""), (2, "again")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, sf).columns == table.columns, name
        assert stage(spark, table.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, table, sf).count() == 4


def test_no_column_name_clashes(spark, sf):
    """documents with a column for every name that a stage or a helper writes in quotes."""
    folder = pathlib.Path(quality.__file__).parent
    source = "".join((folder / f"{m}.py").read_text() for m in ("quality", "simhash", "decontaminate", "personal", "pieces", "common"))
    names = sorted({n.lower() for n in re.findall(r"""["'.]([A-Za-z_]\w*)\b""", source)} | set(re.findall(r"\w+(?= (?:long|int|string|binary|double|boolean)\b)", source)))
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    extra = [n for n in names if n not in docs.columns]
    wide = docs.selectExpr("*", *[f"'mine' as `{n}`" for n in extra])
    assert len(extra) > 150
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, wide, sf)
        assert left.columns == wide.columns, name
        assert sorted(map(str, left.select(docs.columns).collect())) == sorted(map(str, stage(spark, docs, sf).collect())), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, sf).count() == 60


def test_one_row_of_a_repeated_id_stays(spark, docs, sf):
    from promptmill.llm import simhash
    rows = [(5, "one two three four five six"), (5, "quite another text with other words"), (5, "one two three four five six"), (6, "one two three four five six"), (None, "x y"), (None, "x y")]
    first = [sorted(map(str, simhash.stage(spark, docs(rows, parts), sf).collect())) for parts in (1, 3, 6)]
    assert first[0] == first[1] == first[2] and len(first[0]) == 3
