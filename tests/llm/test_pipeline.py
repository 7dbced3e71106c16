import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from geokernel.llm.shared import as_table

from .test_classifiers import SYLLABLES, sentence
from .test_dedup import brute_exact, brute_near

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, tmp):
    rng = random.Random(6)
    rows = []
    for i in range(160):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, sentence(rng, lang, rng.randrange(20, 90)), lang))
    toxic = set(rng.sample(range(160), 45))
    rows = [(i, t + (" grumfoz wixloder grumfazi wixlodu grumfas" if i in toxic else ""), lang) for i, t, lang in rows]
    rows += [(200 + i, rows[i][1].replace(" ", "  "), rows[i][2]) for i in range(20)]
    rows += [(300 + i, rows[i][1] + " extra", rows[i][2]) for i in range(20)]
    rows += [(400, "12 34", None), (401, None, None), (402, "", "aa")]
    docs = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], DOCS)
    docs.repartition(3).write.parquet(f"{tmp}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(160) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    return rows, toxic


def test_stages_against_brute_force(spark, tmp_path):
    rows, toxic = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = as_table(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append((name, before, {r.doc_id for r in docs.collect()}))
    (_, before, kept), (_, _, spoken), exact, near = seen
    copies = {i for i, _ in before if (i % 100 if i >= 200 else i) in toxic and i < 400}
    assert len(kept & copies) <= 2 and len({i for i, _ in before} - copies - kept) <= 2
    assert kept - spoken == {400, 401, 402} & kept
    assert exact[2] == {i for i, _, _, stays, _ in brute_exact(exact[1]) if stays}
    assert near[2] == {i for i, _, _, stays in brute_near(near[1]) if stays}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    texts = {i: t for i, t, _ in rows}
    assert {r.doc_id: r.n for r in got} == {i: len(tokenizer.encode(texts[i], add_special_tokens=False).ids) + 1 for i in near[2]}


def test_rows_are_decided_one_by_one(spark, tmp_path):
    """Rows that share a doc_id, or have none, and columns named like those of the operators."""
    rng = random.Random(8)
    text = lambda: sentence(rng, "aa", 60)
    a, b, c, d = text(), text(), text(), text()
    toxic = "grumfoz wixloder grumfazi wixlodu grumfas "
    rows = [
        (1, a), (1, a), (1, b), (2, b), (2, c), (3, toxic + d), (3, d), (None, a), (None, d), (None, text()), (None, c + " more"), (5, None), (5, ""), (5, " "),
        (6, d + " extra words"), (7, " ".join(sentence(rng, "bb", 1) for _ in range(5000))),
    ]
    train = [(100 + i, (toxic if i % 3 == 0 else "") + sentence(rng, rng.choice(list(SYLLABLES)), 40)) for i in range(120)]
    langs = {i: "aa" for i, _ in rows}
    clash = [F.lit(i).alias(c) for i, c in enumerate(("rejected", "p_toxic", "score", "kept", "row_key", "group", "digest", "node", "row", "a.b"))]
    docs = spark.createDataFrame([(i, t, langs.get(i, "aa"), "s", len(t or "")) for i, t in rows + train], DOCS)
    docs.select("*", *clash).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 1)) for i, _ in train], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = as_table(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns and all(r["a.b"] == 9 and r.row_key == 4 for r in docs.collect())
        seen.append([(r.doc_id, r.text) for r in docs.filter("doc_id < 100 OR doc_id IS NULL").collect()])
    after_toxic, after_language, after_exact, after_near = seen
    assert (3, toxic + d) not in after_toxic and (3, d) in after_toxic and len(after_toxic) == len(rows) - 1
    assert len(after_language) == len(after_toxic) - 3
    of = lambda found, t: sorted((i for i, x in found if x == t), key=repr)
    assert [of(after_exact, t) for t in (a, b, c, d)] == [[1], [1], [2], [3]]
    # c stays over its near copy without an id, d over the copy with a larger one.
    assert [of(after_near, t) for t in (c, c + " more", d, d + " extra words")] == [[2], [], [3], []]
    assert len([i for i, _ in after_near if i is None]) == 1


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_files_of_one_base_name(spark, tmp_path):
    """Copies go wherever their files lie: partitions name their files alike."""
    words = " ".join(f"w{i}" for i in range(80))
    for folder, rows in (("a", [(1, words), (2, "one two three four five six")]), ("b", [(3, words), (4, "six five four three two one")])):
        part = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], DOCS).coalesce(1)
        part.write.parquet(f"{tmp_path}/written/{folder}")
        (tmp_path / f"documents/part={folder}").mkdir(parents=True)
        (file,) = (tmp_path / f"written/{folder}").glob("*.parquet")
        file.rename(tmp_path / f"documents/part={folder}/part-0.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        assert sorted(r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()) == [1, 2, 4]
