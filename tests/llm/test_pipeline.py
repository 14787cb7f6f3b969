import random
from pathlib import Path

import corpus_pipeline
import pytest
from jobtide.llm import common, exact_dedup, packing


def test_drop_exact_duplicates(docs_frame):
    rows = [(1, "a b"), (2, "ab"), (2, "other"), (3, "a  b"), (4, None), (5, ""), (4, None), (None, "ab"), (6, "x"), (6, "x"), (6, "y")]
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.drop_exact_duplicates(docs_frame(rows)).collect()), key=str)
    assert got == sorted([(2, "other"), (3, "a  b"), (4, None), (6, "x"), (6, "y")], key=str)


def write(spark, folder, documents, labels, benchmark):
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_planted_cases(spark, tmp_path):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    texts = {i: words(rng.randint(60, 300)) for i in range(400)}
    toxic = {i for i in range(0, 400, 7)}
    for i in toxic:
        texts[i] = texts[i] + " idiot " + words(3)
    passage = words(30)
    texts[1000] = texts[1].replace(" ", "  ")  # equal, longer: 1000 stays
    texts[1001] = texts[2] + " one more"  # near copy of 2
    texts[1002] = texts[3] + " " + passage + " end"
    texts[1003] = passage
    texts[1004] = None
    texts[1005] = words(2500)
    write(spark, str(tmp_path), [(i, t, "en", "s", len(t or "")) for i, t in texts.items()], [(i, 1, int(i in toxic)) for i in range(400)], [(1, passage)])
    kept = {}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts) - set(kept["toxicity"]) == toxic
    assert set(kept["toxicity"]) - set(kept["exact_dedup"]) == {1}
    assert set(kept["exact_dedup"]) - set(kept["near_dedup"]) == {1001}
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {1003}
    final = kept["decontamination"]
    assert {i for i, t in final.items() if t != texts[i]} == {1002} and passage not in final[1002]
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).toPandas()
    assert set(packed.doc_id) == set(final) and packed.length.max() <= packing.SEQUENCE
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[columns].values.tolist())) == sorted(map(tuple, packed[columns].values.tolist()))


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_scratch_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_root", lambda _: f"file://{tmp_path}/scratch")
    left = lambda: sorted(p.name.rsplit("-", 1)[0] for p in Path(tmp_path, "scratch", "jobtide").iterdir())
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(30)]
    texts += [texts[0], texts[1] + " more", texts[2] + " idiot"]
    write(spark, f"{tmp_path}/in", [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], [(i, 1, int(i == 32)) for i in range(33)], [(1, texts[5])])
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").count()
    # what the lazy last stage reads
    assert left() == ["pieces", "stage-decontamination"]
    with pytest.raises(ZeroDivisionError), common.scratch_scope(spark) as keep:
        kept = keep(common.scratch_table(spark.range(2), "kept"))
        common.scratch_table(spark.range(2), "lost")
        raise ZeroDivisionError
    assert left() == ["kept", "pieces", "stage-decontamination"] and kept.count() == 2
