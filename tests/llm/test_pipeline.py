import corpus_pipeline
from partlens.llm import quality
from partlens.llm.common import WORD, stored
from tests.conftest import DATA
from tests.llm.cases import table
from tests.llm.test_simhash import plain_components, plain_print
from tests.llm.test_substrings import plain


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.asDict() for r in docs.collect()}
        after = stored(stage(spark, docs, DATA), "test")
        assert after.columns == columns
        rows = {r.doc_id: r.asDict() for r in after.collect()}
        assert after.count() == len(rows)
        if name == "quality classifier":
            scores = quality.scored(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
            want = {r.doc_id: before[r.doc_id] for r in scores.collect() if r.predicted == 1}
        elif name == "exact dedup":
            last = {before[i]["text"]: i for i in sorted(before)}
            want = {i: before[i] for i in last.values()}
        elif name == "simhash near dedup":
            ids = sorted(before)
            groups = plain_components([plain_print(before[i]["text"]) for i in ids], 4)
            want = {ids[n]: before[ids[n]] for n in sorted(set(groups))}
        else:
            want = {}
            for i, words, gone, text in plain([(i, before[i]["text"]) for i in before], 50):
                if not gone:
                    want[i] = before[i]
                elif gone < words:
                    want[i] = before[i] | {"text": text, "n_chars": len(text)}
        assert rows == want, name
        kept.append(len(rows))
        docs = after
    assert len(before) >= kept[-1] and kept == sorted(kept, reverse=True) and kept[0] < 200
    packed = corpus_pipeline.batches(spark, docs, DATA).collect()
    held = {}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.piece)):
        words = r.content.split(" ") if r.content else []
        assert len(words) == r.length
        held.setdefault(r.doc_id, []).extend(words)
    assert held == {r.doc_id: WORD.findall(r.text) for r in docs.collect()}


def test_labels_only_train(spark, docs, frame, tmp_path):
    """The awkward rows pass through every stage with their columns."""
    frame([(0, 1), (30, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, str(tmp_path)), "test")
        assert now.columns == docs.columns
    assert now.count() > 3
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() >= now.count()


CLASHING = ["_score", "_key", "_kept", "_first", "_at_file", "_at_row", "_metadata", "_number", "a.b", "_held", "_text", "content"]


def test_columns_of_any_name(spark, frame, tmp_path):
    """Names that stages and operators use themselves pass through with what they hold."""
    frame([(0, 1), (30, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(*r[:5], *[f"{name} {r[0]}" for name in CLASHING]) for r in table()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    now = frame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, str(tmp_path)), "test")
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING], name
        got = now.collect()
        assert len(got) > 3 and all(r[5 + n] == f"{c} {r.doc_id}" for r in got for n, c in enumerate(CLASHING)), name
    assert corpus_pipeline.batches(spark, now, "").count() >= len(got)


def test_empty(spark, empty, frame, tmp_path):
    frame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, str(tmp_path)), "test")
        assert now.count() == 0
