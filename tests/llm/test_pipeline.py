"""The pipeline's stages on awkward rows, each against a plain version of its decision."""

import random

import numpy as np
import pytest
import sentencepiece
from helpers_llm import LONG, SCHEMA, awkward, empty
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidewatch.llm import queries, toxicity
from tidewatch.llm.common import in_fold, passing_tables, stored

BENCHMARK = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with nulls, repeats, copies, near copies, a benchmark passage, insults, and columns of the results' names."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(2)
    words = ["".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(200)]
    rows = [(100 + i, " ".join(words[i : i + 120]), "en", "a", 1, 0.0, "k", 0) for i in range(0, 60, 20)]
    rows += [(200, " ".join([*words[:60], "other", *words[61:120]]), "en", "a", 1, 0.0, "k", 0), (201, f"Before. {BENCHMARK} after.", "en", "b", 1, 0.0, "k", 0)]
    insults = [(300 + i, f"You {x} and {y} number {i}, worthless idiot, pathetic moron!", "en", "c", 1, 0.0, "k", 0) for i, (x, y) in enumerate([("scum", "loser"), ("liar", "cheat")] * 15)]
    polite = [(400 + i, f"A quiet walk along river {i}, with {words[i]} {words[i + 1]} other and some flowers of kind {i * 7}; {i} two three seven.", "en", "c", 1, 0.0, "k", 0) for i in range(30)]
    docs = awkward(spark).union(spark.createDataFrame(rows + insults + polite, SCHEMA)).withColumns({"ids": F.lit("mine"), "n_tokens": F.lit(7), "kept_text": F.lit("kept"), "N_DROPPED": F.lit(1)})
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([("b1", BENCHMARK), ("b2", None), (None, "")], "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    labels = [(r[0], 1, 1) for r in insults] + [(r[0], 1, 0) for r in polite] + [(r[0], 1, 0) for r in rows] + [(None, 1, 1), (1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_every_stage_by_a_plain_version(spark, folder):
    docs = queries.table(spark, folder, "documents")
    columns = docs.columns
    after = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, folder), "tested-stage")
        after[name] = (before, docs)
        assert docs.columns[: len(columns)] == columns

    before, toxic = after["toxicity"]
    model = toxicity.fit_toxicity(before, queries.table(spark, folder, "labels"), ~in_fold(F.col("doc_id"), 3, 1))
    weights, bits = model.weights, len(model.weights).bit_length() - 1

    def score(text):
        slots = {int(s) for part in toxicity.gram_slots(text or "", model.shortest, model.longest, bits) for s in part}
        return 1 / (1 + np.exp(-np.clip((sum(float(weights[s]) for s in slots) + model.bias), -30, 30)))

    assert rows_of(toxic, "doc_id", "text") == [(i, t) for i, t in rows_of(before, "doc_id", "text") if score(t) < 0.7]
    assert not [i for i, _ in rows_of(toxic, "doc_id", "text") if i and 300 <= i < 400]
    assert len([i for i, _ in rows_of(toxic, "doc_id", "text") if i and 400 <= i]) == 30

    before, lines = after["line dedup"]
    assert lines.count() == before.count()
    old, new = ({i: t for i, t in rows_of(x, "doc_id", "text") if i} for x in (before, lines))
    assert new[2] == "" and new[200] == "" and new[3] is None and new[7] == LONG and new[100] == old[100] and new[120] == old[120]
    assert [n for (n,) in rows_of(lines.where("doc_id = 2"), "n_chars")] == [0] and [n for (n,) in rows_of(lines.where("doc_id = 9"), "n_chars")] == [1]

    before, single = after["n-gram Jaccard join"]
    kept = rows_of(before.distinct(), "doc_id", "text")
    seen, want = set(), []
    for i, t in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0)):
        w = decontaminate_words(t)
        grams = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None
        if grams is None or not any(len(grams & g) >= 0.8 * len(grams | g) for g in seen):
            want.append((i, t))
            seen |= {grams} if grams else set()
    assert rows_of(single, "doc_id", "text") == sorted(want, key=str)

    before, clean = after["benchmark decontamination"]
    assert {r[0] for r in rows_of(before, "doc_id")} - {r[0] for r in rows_of(clean, "doc_id")} == {201}
    assert clean.count() == before.count() - 1

    before, encoded = after["SentencePiece encoding"]
    assert encoded.columns == [*columns, "n_tokens_2", "ids_2", "decoded"]
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.tokenizer_model())
    for r in encoded.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert (r.ids, r.n_tokens, r.kept_text, r.N_DROPPED) == ("mine", 7, "kept", 1)
        assert np.frombuffer(r.ids_2, "<u4").tolist() == ids and r.n_tokens_2 == len(ids) and r.decoded == library.decode(ids)
    assert encoded.count() == before.count()


def decontaminate_words(text):
    import re

    return [w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def test_run_equals_its_stages_and_deletes_what_passes(spark, folder):
    import os

    from tidewatch.session import shared_dir

    shared = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(shared))
    got = pipeline.run(spark, folder)
    left = set(os.listdir(shared)) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-SentencePiece")
    assert got.count() > 30 and 201 not in {r[0] for r in rows_of(got, "doc_id")}


def test_run_on_no_documents(spark, folder, tmp_path):
    root = str(tmp_path)
    empty(spark).write.parquet(f"{root}/documents.parquet")
    for name in ("benchmark", "labels"):
        queries.table(spark, folder, name).write.parquet(f"{root}/{name}.parquet")
    assert pipeline.run(spark, root).count() == 0


def test_passing_tables_are_deleted_even_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), passing_tables(spark):
        kept = stored(spark.range(3).toDF("x"), "passing")
        assert kept.count() == 3
        raise ZeroDivisionError
    with pytest.raises(Exception, match="does not exist|FAILED_READ_FILE|PATH_NOT_FOUND"):
        kept.sparkSession.read.parquet(kept.inputFiles()[0] if kept.inputFiles() else "gone").count()


def test_names_of_added_columns(spark):
    assert pipeline.unused("ids", spark.range(1).toDF("IDS")) == "ids_2" and pipeline.unused("ids", spark.range(1)) == "ids"
