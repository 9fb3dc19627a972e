"""The stages of the pipeline on the smallest documents, each against what its input asks for."""

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
_shared = pytest.importorskip("terravane.llm._shared")

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The input and the result of each stage, by name."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(folder / name))
        out[name] = docs, spark.read.parquet(str(folder / name))
        docs = out[name][1]
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(stages):
    assert list(stages) == ["toxicity", "language", "near_copies", "repeats", "packing"]
    for name, (_, after) in stages.items():
        assert (sorted(after.columns) == sorted(COLUMNS)) == (name != "packing")


def test_filters_keep_rows_as_they_are(stages):
    for name in ("toxicity", "language", "near_copies"):
        before, after = map(_rows, stages[name])
        assert 0 < len(after) <= len(before) and all(after[k] == before[k] for k in after)
        assert len(after) > 0.6 * len(before)


def test_one_of_each_copy_stays(stages):
    before, after = map(_rows, stages["near_copies"])
    plain = lambda r: " ".join(r.text.lower().split())
    first = {}
    for k, r in sorted(before.items()):
        first.setdefault(plain(r), k)
    assert len({plain(r) for r in after.values()}) == len(after)
    assert all(first[plain(r)] == k for k, r in after.items())


def test_no_string_of_fifty_bytes_is_left_in_a_later_document(stages):
    before, after = map(_rows, stages["repeats"])
    assert set(before) == set(after)
    seen = set()
    for k in sorted(before):
        raw = before[k].text.encode()
        own = {raw[i : i + 50] for i in range(len(raw) - 49)}
        if not own & seen:
            assert after[k].text == before[k].text
        else:
            assert len(after[k].text) < len(before[k].text)
        seen |= own
        assert after[k].n_chars == len(after[k].text)


def test_all_that_is_left_is_packed(stages):
    before, pieces = stages["packing"]
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(_rows(before))
    totals = pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in totals)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages["packing"][1].count()


def test_toxicity_by_plain_scores(spark, sf_dir, stages):
    """Of each text the word by word differences, their curve, and nothing else decide."""
    import numpy as np

    from terravane.llm import toxicity

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    before, after = map(_rows, stages["toxicity"])
    for k, r in before.items():
        gain = sorted((float(model.difference([w])[0, 0]) for w in r.text.lower().encode().split()), reverse=True)
        best = [min(g, toxicity.WORD_GAIN) for g in (gain[:2] if len(gain) > 1 else [*gain, 0.0][:2])]
        x = np.dot([1, np.mean(gain), sum(best) / 2, best[0] if len(gain) > 1 else max(0.0, best[0])], model.curve) if gain else model.curve[0]
        assert abs(x) < 1e-3 or (k in after) == (x < 0)
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([(k in after) != bool(t) for k, t in marked.items() if k in before]) > 0.95


def test_language_by_plain_costs(spark, sf_dir, stages):
    import numpy as np

    from terravane.llm import language_id

    model = language_id.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    before, after = map(_rows, stages["language"])
    for k, r in before.items():
        words = r.text.lower().encode().split()
        bits = sum((model.cost([w])[0].astype(float) for w in words), np.zeros(len(model.languages)))
        share = 1 / sum(2.0 ** -min(1000, (b - bits.min()) / max(len(words), 1) * min(8, max(1, len(words)))) for b in bits)
        assert abs(share - corpus_pipeline.LEAST_SHARE) < 1e-3 or (k in after) == (any(c.isalpha() for c in r.text) and share >= corpus_pipeline.LEAST_SHARE)


def test_odd_rows_go_through_all_stages(spark, sf_dir, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns, and no rows at all."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, bits long, queue int, score double, kept string"
    rows = [(1, None, None, None, None, 1, 2, 0.5, "x"), (2, "", "en", "s", 0, 1, 2, 0.5, "x"), (None, "the house is large and old", "en", None, 26, 1, 2, 0.5, "x"), (3, "the house is large and old", None, "s", 26, 1, 2, 0.5, "x"), (4, "word and house " * 40_000, "en", "t", 600_000, 1, 2, 0.5, "x"), (5, "\u0000 … 123", "en", "s", 7, 1, 2, 0.5, "x")]
    for n, given in enumerate((rows + rows[:4], [])):
        docs = spark.createDataFrame(given, kinds)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{n}-{name}")
            out = spark.read.parquet(f"{tmp_path}/{n}-{name}")
            assert out.columns == COLUMNS or name == "packing"
            assert given or out.count() == 0
            docs = out.selectExpr("*", "1L as bits", "2 as queue", "0.5D as score", "'x' as kept") if name != "packing" else out


def _batch_sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_send_rows_by_small_batches(spark, sf_dir, stage):
    """An executor's memory must not follow how many rows Spark would put in a batch."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    dict(corpus_pipeline.STAGES)[stage](spark, spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20), sf_dir)
    sizes = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).mapInArrow(_batch_sizes, "size long").collect()
    assert sum(r["size"] for r in sizes) > 40 << 20
    assert max(r["size"] for r in sizes) < 10 << 20
    spark.conf.set(setting, "1m")
    _shared.small_batches(spark)
    assert spark.conf.get(setting) == "1m"  # a smaller bound stays
    spark.conf.unset(setting)


def test_workers_give_memory_back(monkeypatch):
    """What a worker freed goes back to the system also where no operator left anything."""
    asked = []
    monkeypatch.setattr(_shared.ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=asked.append))
    _shared.forget()
    _shared.forget()
    assert asked == [0, 0]
