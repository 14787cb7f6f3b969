"""Every query and every pipeline stage on odd tables: nulls in any column, empty and very long texts, ties,
repeated rows, empty tables, and extra columns with names that operators use themselves."""

import random

import corpus_pipeline
import pytest
from jobtide.llm import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names of columns that operators make, given to a string column of the input.
CLASHES = [
    "id", "fp", "sha", "a", "b", "n", "key", "row", "own", "label", "first", "bucket", "bands", "list", "ids", "low", "high", "score", "rejected", "predicted", "held_out", "keep_id", "kept", "group_size",
    "group_id", "root", "component_id", "fingerprint", "start", "piece", "length", "offset", "sequence_id", "n_tokens", "n_hit", "n_words", "n_items", "host", "html_text", "toxic", "slots", "batch", "part", "chunk", "lang_pred",
    "digest", "prefix", "gram", "m", "kind", "rep", "pop", "hub", "grams", "pairs", "pair", "n_a", "n_links", "rest", "best", "q", "code", "error", "entry", "place", "total", "_label",
]
#: Columns that do not depend on how rows are dealt over tasks.
STABLE = {"op5_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32"], "packing": ["doc_id", "piece", "start", "length", "ids_crc32"]}


def tables(null_ids: bool):
    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    passage, long = words(40), words(60_000)
    texts = [None, "", " \t\n", "a", "A", "!?", "\x00\x0b", "日本語 текст ñ 🙂", long, long, long + " end", passage, "x " + passage + " y", words(30), words(30)]
    docs = [(i, t, random.Random(i).choice(["en", "fr", None]), None if i % 3 else "s", len(t or "") or None) for i, t in enumerate(texts)]
    docs += [(20 + i, words(50) + (" idiot" if i % 2 else ""), "en" if i % 4 < 2 else "fr", "s", 1) for i in range(40)]
    docs += [docs[0], docs[8], docs[13], docs[13], (13, "another text of a known id", "en", "s", 26)]
    if null_ids:
        docs += [(None, passage, "en", "s", 1), (None, None, None, None, None), (None, passage, "en", "s", 1)]
    labels = [(20 + i, 1, i % 2) for i in range(40)] + [(20, 0, 0), (21, None, None), (None, 1, 1), (999, 1, 1)]
    items = [(1, passage), (2, None), (3, ""), (4, "short item"), (1, passage), (None, words(12))]
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<html><body><nav>menu</nav><p>{words(20)}</p></body></html>") for i in range(6)]
    pages += [(6, None, None), (7, "", ""), (8, "no url", "<div>" * 3000 + "deep"), (0, "http://h0.org/0", "<p>again"), (None, "http://h1.org/x", "plain " + long)]
    return docs, labels, items, pages


#: Kept ones first.
VECTORS = [(i, [((i * 7 + k) % 11) / 10 - 0.5 for k in range(16)], i % 3 or None) for i in range(40)] + [(3, [0.25] * 16, 1), (3, [0.25] * 16, 1), (None, [0.5] * 16, None)]
DROPPED = [(50, None, 1), (51, [], 1), (52, [None] * 16, 1), (53, [float("nan")] * 16, 2), (54, [0.5] * 8, 2)]


def write(spark, folder, docs, labels, items, pages, extra=(), vectors=VECTORS + DROPPED):
    shapes = {"embeddings": (vectors, "vec_id long, embedding array<float>, label int"), "documents": (docs, DOCS), "labels": (labels, "doc_id long, quality int, toxic int"), "benchmark": (items, "item_id long, text string"), "pages": (pages, "page_id long, url string, html string")}
    for name, (rows, schema) in shapes.items():
        known = {c.split()[0] for c in schema.split(", ")}
        more = [c for c in extra if c not in known]
        shape = ", ".join([schema, *(f"{c} string" for c in more)])
        spark.createDataFrame([(*r, *(["clash"] * len(more))) for r in rows], shape).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def result(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    made = {"plain": tables(False), "nulls": tables(True)}
    found = {name: write(spark, tmp_path_factory.mktemp(name), *rows) for name, rows in made.items()}
    found["clash"] = write(spark, tmp_path_factory.mktemp("clash"), *made["nulls"], extra=CLASHES)
    found["empty"] = write(spark, tmp_path_factory.mktemp("empty"), [], [], [], [], vectors=[])
    return found


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries(spark, odd, name):
    query, (docs, _, _, pages) = queries.QUERIES[name], tables(True)
    given = {"page_id": pages, "vec_id": VECTORS}
    whole = query(spark, odd["nulls"])
    columns = STABLE.get(name, whole.columns)
    rows = result(whole, columns)
    assert rows == result(query(spark, odd["clash"]), columns)
    if name != "op5_best_fit_packing":  # a row per piece there
        assert len(rows) == len(given.get(columns[0], docs))
    assert {r[columns[0]] for r in whole.select(columns[0]).collect()} == {r[0] for r in given.get(columns[0], docs)}
    nothing = query(spark, odd["empty"])
    assert nothing.columns == whole.columns and nothing.count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, name, stage):
    docs = {k: spark.read.parquet(f"{path}/documents.parquet") for k, path in odd.items()}
    whole = stage(spark, docs["nulls"], odd["nulls"])
    columns = STABLE.get(name, whole.columns)
    rows = result(whole, columns)
    assert rows == result(stage(spark, docs["clash"], odd["clash"]), columns)
    if name != "packing":
        assert whole.columns == corpus_pipeline.COLUMNS
        # what stays is untouched, but for passages that are cut
        given = {repr(r) for r in docs["nulls"].collect()}
        assert name == "decontamination" or set(rows) <= given
        assert stage(spark, docs["empty"], odd["empty"]).count() == 0
    # rows without an id are documents too: they are dropped on their texts only
    if name in ("toxicity", "near_dedup"):
        assert sum("doc_id=None" in r for r in rows) == 3
