import math
import random
import re
import textwrap
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from geokernel.llm import language_id, licenses, toxicity
from geokernel.llm.grams import gram_counts, hashed_grams
from geokernel.llm.license_texts import KNOWN
from geokernel.llm.samples import Bags, lowest_draws

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "ung", "keit", "ber"], "cc": ["eau", "oi", "que", "ment"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def language_rows(n=240, seed=0):
    rng = random.Random(seed)
    return [(i, sentence(rng, lang, rng.randrange(3, 60)), lang) for i, lang in ((i, rng.choice(list(SYLLABLES))) for i in range(n))]


def test_language_id_on_held_out_rows_and_edges(spark):
    rows = language_rows()
    edges = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? \n", "bb"), (1003, "schlungkeit " * 20_000, None), (None, "katomi ru", "aa"), (0, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame(rows + edges, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language_id.fit_from_documents(docs)
    assert model.languages == ["aa", "bb", "cc"]
    got = language_id.identify(docs, model).withColumn("held", language_id.in_fold("doc_id", 0)).collect()
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.held and r.doc_id in truth]
    assert len(held) > 20 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows + edges)
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "bb" and by_id[None].lang_pred == "aa"
    assert not any(by_id[i].rejected for i in truth)
    kept = language_id.identify(docs.drop("score"), model, keep_columns=True)
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]


def test_language_id_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language_id.fit_from_documents(docs)
    assert [tuple(r) for r in language_id.identify(docs, model).collect()] == [(1, "und", 0.0, True)]
    assert language_id.identify(docs.limit(0), model).collect() == []


def test_scores_are_calibrated_by_a_temperature():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 3000)
    z = rng.normal(0, 1, (3000, 3))
    z[np.arange(3000), truth] += 1.5
    temperature, _ = language_id._calibrate(10 * z, truth)
    p = language_id._softmax(10 * z / temperature)
    assert abs(p.max(axis=1).mean() - (p.argmax(axis=1) == truth).mean()) < 0.03


def toxic_rows(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = sentence(rng, rng.choice(list(SYLLABLES)), rng.randrange(20, 120)).split()
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randrange(4, 9)):
            words.insert(rng.randrange(len(words)), rng.choice(["grumfoz", "grumfazi", "wixloder"]) + rng.choice(["", "u", "as"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_chain_on_rows_without_label(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (9002, "12 ?"), (None, "ka to"), (9003, "katomi " * 20_000)], "doc_id long, text string").withColumn("rejected", F.lit(3))
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows if i % 3] + [(5, 1, None), (None, 1, 1), (9001, 1, 0)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_from_labels(docs, labels)
    assert len(chain.models) == 3 and [len(m.extra) for m in chain.models] == [0, 1, 2]
    got = {r.doc_id: r for r in toxicity.score_documents(docs, chain).collect()}
    fresh = [(got[i].rejected, bool(t)) for i, _, t in rows if i % 3 == 0]
    assert np.mean([r for r, t in fresh if t]) > 0.95
    assert np.mean([r for r, t in fresh if not t]) < 0.02
    assert not any(got[i].rejected for i in (9000, 9001, 9002, 9003, None))
    assert got[9000].p_toxic == 0
    assert toxicity.score_documents(docs.limit(0), chain).collect() == []
    nothing = toxicity.fit_from_labels(docs, labels.limit(0))
    assert not any(r.rejected for r in toxicity.score_documents(docs, nothing).collect())


def test_later_models_use_earlier_probabilities():
    """A label that only the earlier category reveals is learned through the chain."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    bags = [np.unique(hashed_grams("yes indeed" if v else "never", toxicity.GRAMS, toxicity.BITS)) for v in y]
    counts = [np.ones(len(b), int) for b in bags]
    chain = toxicity.train_chain(bags, counts, np.column_stack([y, y]), categories=("first", "second"))
    assert chain.models[1].extra[0] > 0
    assert chain.predict("yes indeed")[1] > 0.5 > chain.predict("never")[1]


def test_scores_of_a_given_chain_against_plain_sums(spark):
    """What score_documents gives for a fixed chain, by sums over the n-grams one by one."""
    rng = np.random.default_rng(4)
    place = np.full(1 << toxicity.BITS, -1, np.int32)
    texts = ["Ka tomi ruka", "schlung! schlung\n42 berkeit", "katomi " * 5000, "é ß", "", None]
    known = np.unique(np.concatenate([hashed_grams(t, toxicity.GRAMS, toxicity.BITS) for t in texts if t]))[::2]
    place[known] = np.arange(len(known))
    models = [toxicity.Linear(rng.normal(0, 1, len(known)).astype(np.float32), float(rng.normal()), rng.normal(0, 1, k)) for k in range(3)]
    chain = toxicity.Chain(place, rng.uniform(0.5, 3, len(known)).astype(np.float32), models, threshold=0.5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score_documents(docs, chain).collect():
        counts = {}
        for g in hashed_grams(texts[r.doc_id] or "", toxicity.GRAMS, toxicity.BITS).tolist():
            if place[g] >= 0:
                counts[place[g]] = counts.get(place[g], 0) + 1
        want = []
        v = {k: math.log1p(n) * chain.idf[k] for k, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()) + toxicity.DAMPING)
        for m in models:
            z = sum(toxicity.SCALE * x / norm * m.weights[k] for k, x in v.items()) + m.bias + sum(e * p for e, p in zip(m.extra, want, strict=True))
            want.append(1 / (1 + math.exp(-z)) if counts else 0.0)
        assert np.allclose([r.p_explicit, r.p_dense, r.p_toxic], want, atol=1e-5) and r.rejected == (r.p_toxic >= 0.5)


def test_languages_of_a_given_model_against_plain_means(spark):
    rng = np.random.default_rng(5)
    model = language_id.LanguageModel(["aa", "bb", "cc"], rng.normal(0, 1, (1 << language_id.BITS, 3)).astype(np.float32), rng.normal(0, 1, 3), 0.7, 0.4)
    texts = ["Ka tomi ruka", "schlung! schlung", "katomi " * 5000, "42", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.identify(docs, model).collect():
        grams = hashed_grams(texts[r.doc_id] or "", language_id.GRAMS, language_id.BITS)
        if not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        z = (model.bias + np.mean([model.table[g] for g in grams], axis=0, dtype=float)) / 0.7
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.languages[p.argmax()] and abs(r.score - p.max()) < 1e-5 and r.rejected == (r.score < 0.4)


def test_long_texts_are_hashed_in_slices():
    rng = random.Random(2)
    text = "".join(rng.choice("ab Éß .9") for _ in range(30_000)) + "c" * 9000
    whole = np.unique(hashed_grams(text, (2, 3, 4), 16), return_counts=True)
    for size in (7, 100, 5000, 10**6):
        u, c = gram_counts(text, (2, 3, 4), 16, size=size)
        assert np.array_equal(u, whole[0]) and np.array_equal(c, whole[1])


def test_chain_against_a_single_model(spark):
    """On rows that no fit saw, the chain catches at least what one model of the label does."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels, "doc_id").select("doc_id", "text", "toxic").orderBy(F.xxhash64("doc_id")).limit(4000).collect()
    bags = [gram_counts(r.text or "", toxicity.GRAMS, toxicity.BITS) for r in rows]
    y = np.array([r.toxic for r in rows])
    stems = Bags.of([toxicity.stems_of(r.text or "") for r in rows], "<u4", "<u4")
    known = toxicity.Stems(stems, y)
    cut = 3 * len(rows) // 4
    fold = np.arange(cut) % toxicity.FOLDS
    train = Bags.of(bags[:cut], "<u4", "<u4")
    columns = known.categories(np.arange(cut))
    found = {}
    for name, picked in (("chain", [0, 1, 2]), ("single", [2])):
        chain = toxicity.train_rows(train, lambda fit, picked=picked: columns[:cut][:, picked], tuple(toxicity.CATEGORIES[k] for k in picked), fold)
        p = np.array([chain.predict(r.text)[-1] for r in rows[cut:]])
        found[name] = (p[y[cut:] == 1] >= chain.threshold).mean(), (p[y[cut:] == 0] >= chain.threshold).mean()
    (caught, lost), (caught_alone, lost_alone) = found["chain"], found["single"]
    assert caught >= caught_alone - 0.02 and lost <= lost_alone + 0.002
    assert caught > 0.75 and lost < 0.01


def test_samples_are_bounded_whatever_repeats(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("by"))
    for by in (0, 1):
        got = [r.k for r in lowest_draws(rows, "by", 160, F.xxhash64("k")).filter(F.col("by") == by).collect()]
        # Rows that repeat fill their own shard alone.
        assert len(got) <= 160 and len(set(got)) >= 120
    few = lowest_draws(rows, "by", 3, F.xxhash64("k")).groupBy("by").count().collect()
    assert [r["count"] for r in few] == [3, 3]


def test_tags_beyond_the_bound_are_not_learned(spark):
    rows = [(i, sentence(random.Random(i), "aa", 20), f"tag{i:04d}") for i in range(400)] + [(1000 + i, sentence(random.Random(i), "bb", 20), "bb") for i in range(40)]
    model = language_id.fit_from_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == language_id.LANGUAGES and "bb" in model.languages


def test_licences_in_other_spellings(spark):
    mit = KNOWN["MIT"].replace("sublicense", "sub-licence").upper()
    rows = [
        (1, f"Copyright (c) 2020 A. Person\n(C) 2021 Others\n{mit}\n"),
        (2, KNOWN["BSD-3-Clause"].replace("copyright holder", "copyright owner").replace("\n", "\r\n   ")),
        (3, f"Some text.\nReleased under the MIT LICENCE\nLicensed under CC BY-NC 4.0\nLicensed under CC BY-NC 4.0."),
        (4, None), (5, ""), (6, "?!"), (7, KNOWN["MIT"] + " and more"), (None, KNOWN["ISC"]), (8, "licence " * 30_000), (1, KNOWN["Zlib"]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license_id", F.lit("clash"))
    got = sorted(((r.doc_id, r.license_id, r.n_notices, r.notice_ids) for r in licenses.scan(docs).collect()), key=repr)
    assert [g for g in got if g[0] == 1] == [(1, "MIT", 0, ""), (1, "Zlib", 0, "")]
    by_id = {g[0]: g[1:] for g in got}
    assert by_id[2][0] == "BSD-3-Clause" and by_id[None][0] == "ISC"
    assert by_id[3] == (None, 3, "CC-BY-NC-4.0 (notice),MIT (notice)")
    assert all(by_id[i][0] is None for i in (4, 5, 6, 7, 8))
    assert len({r.text_digest for r in licenses.scan(docs).filter("doc_id IN (4, 5, 6)").collect()}) == 1
    assert licenses.scan(docs.limit(0)).collect() == []


def test_licences_however_they_are_wrapped(spark):
    rows = []
    for name, text in KNOWN.items():
        rows += [(name, textwrap.fill(text, width, break_long_words=False, break_on_hyphens=False)) for width in (20, 33, 47, 60, 79, 10**6)]
        rows.append((name, re.sub(r"\s+(?=copyright)", "\n", text, flags=re.I)))
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib"):
        held = "Copyright (c) 2020-2021 Some Body, Inc. and others\n\n" + KNOWN[name]
        rows += [(name, textwrap.fill(held, width, break_long_words=False, break_on_hyphens=False)) for width in (20, 60, 10**6)]
        rows += [(name, f"{line}\n{KNOWN[name]}") for line in ("Copyright The Some Authors. All rights reserved.", "(C) Some Body 2020", "© Some Body")]
    ids = {k: i for i, k in enumerate(KNOWN)}
    docs = spark.createDataFrame([(ids[k], t) for k, t in rows], "doc_id long, text string")
    assert [list(KNOWN)[r.doc_id] for r in licenses.scan(docs).collect() if r.license_id != list(KNOWN)[r.doc_id]] == []


def test_long_notices_and_the_sql(spark, tmp_path):
    """Notices of any length before a licence, and the SQL of op1 on planted texts."""
    import duckdb

    from geokernel.llm import registry

    long = "Copyright (c) 2015-2024 " + ", ".join(f"Contributor Number{i} <c{i}@example.org>" for i in range(400)) + "."
    fill = lambda t, width: textwrap.fill(t, width, break_long_words=False, break_on_hyphens=False)
    rows = [("MIT", f"{fill(long, 70)}\n\n{KNOWN['MIT']}"), ("MIT", f"{long} {fill(KNOWN['MIT'], 10**6)}"), ("ISC", fill(KNOWN["ISC"], 10**6)), ("ISC", f"Copyright Some Body\n{KNOWN['ISC']}")]
    rows += [(None, f"copyright 2001 by A. The copyright of this. {KNOWN['MIT']}"), (None, "A copyright law, 2010.\nPermission is hereby granted"), (None, None), (None, ""), (None, "Released under the MIT LICENCE\nnothing")]
    rows += [(name, text) for name, text in KNOWN.items()] + [(name, f"(c) 2020 Some Body\n© Others\n{text}") for name, text in KNOWN.items() if "notice" not in name]
    gpl = Path("/usr/share/common-licenses/GPL-3")
    rows += [("GPL-3.0", gpl.read_text(encoding="utf-8"))] if gpl.exists() else []
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents")
    columns = ["doc_id", "text_digest", "license_id", "n_notices", "notice_ids"]
    found = sorted(map(tuple, licenses.scan(docs).select(*columns).collect()))
    assert [f[2] for f in found] == [name for name, _ in rows]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES['op1_license_scan']})").fetchall()) == found


def test_full_standard_texts(spark):
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    found = {k: Path("/usr/share/common-licenses", f) for k, f in files.items()}
    texts = {k: p.read_text(encoding="utf-8") for k, p in found.items() if p.exists()}
    ids = list(texts)
    docs = spark.createDataFrame([(ids.index(k), t) for k, x in texts.items() for t in (x, textwrap.fill(x, 50, break_long_words=False, break_on_hyphens=False), textwrap.fill(x, 10**6, break_long_words=False, break_on_hyphens=False))], "doc_id long, text string")
    assert all(r.license_id == ids[r.doc_id] for r in licenses.scan(docs).collect())
