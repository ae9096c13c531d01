"""Line rules, language, quality, licenses and language model against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from edge_rows import EDGES
from oracle import connect, differences
from pyspark.sql import functions as F

from galewright.llm import language_id, license_scan, line_rules, ngram_lm, quality
from galewright.llm.frames import bounded_sample, remainder


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def measured(text):
    found, lines, seen, dup = words(text), [line for line in (text or "").split("\n") if words(line)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= set(range(i, i + 5))
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_line_measures_equal_plain_python(edges, docs):
    for table in (edges, docs.limit(300)):
        text = {tuple(r) for r in table.select("doc_id", "text").collect()}
        found = line_rules.judge_lines(table).collect()
        assert len(found) == table.count()
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
        assert set(got) == {(i, *measured(t)) for i, t in text}


def test_lines_are_removed_and_documents_that_lose_too_much_rejected(spark):
    good = "This line has a good many words and it ends as it should."
    other = "Quite different words stand here, so that no window comes twice."
    rows = [
        (1, f"{good}\nHome | About | Help | Contact\n{other}"),
        (2, "Menu\n*** this*** is*** all*** junk*** and*** nothing*** else*** at*** all***"),
        (3, f"{good}\n{good}"),
        (4, "We value this. All rights reserved by us, the one and only owners of it.\n" + good),
    ]
    found = {r.doc_id: r for r in line_rules.judge_lines(spark.createDataFrame(rows, "doc_id long, text string"), clean=True).collect()}
    assert found[1].kept and found[1].cleaned == f"{good}\n{other}" and found[1].navigation_words == 7
    assert not found[2].kept and not found[2].base_failed and found[2].cleaned == "" and found[2].punctuation_words == 11
    assert found[3].base_failed and not found[3].kept and found[3].cleaned == good
    assert found[4].boilerplate_words == 15 and found[4].cleaned == good


PROSE = "The committee met in the old hall on Monday and spoke for hours about the bridge."
MENU = "Home About Products Services Contact Login"
PAGES = {
    "menu": "\n".join([MENU, "News Events Jobs Partners Press Imprint", "Garden Tools Seeds Pots Sale Brands", "Account Cart Orders Wishlist Help Logout"]),
    "shouting": "BUY! NOW! HERE!\nCHEAP! FAST! SAFE! CALL!\nBEST! PRICE! EVER! ORDER TODAY!",
    "capitals": "EVERYTHING MUST GO BEFORE THE END OF THIS WEEK AND NOTHING WILL BE KEPT.",
    "breadcrumbs": "\n".join(f"Home \u00bb Shop \u00bb Garden \u00bb Shelf {i}" for i in range(8)),
    "paths": "\n".join(f"home/shop/garden/shelf{i} home/news/{i}/all next" for i in range(6)),
    "list": "\n".join(["buy garden tools online", "seeds and pots on sale", "our shops near you", "track your order here", "write to our team", "terms for dealers"]),
}


def test_page_furniture_is_removed(spark):
    rows = [(i, page) for i, page in enumerate(PAGES.values())]
    for r in line_rules.judge_lines(spark.createDataFrame(rows, "doc_id long, text string"), clean=True).collect():
        assert not r.kept and len(r.cleaned.split()) <= 0.5 * r.n_words, list(PAGES)[r.doc_id]


def test_prose_keeps_its_lines(spark):
    other = "Nobody had expected that; the mayor, who came late, asked for a vote. Was it needed? Most thought so!"
    verse = "the river runs below the hill and slowly\nit turns to where the willows used to stand\nthe water brings the morning to the valley\nand takes the evening with it to the sand."
    german = "Der Rat der Stadt trat am Montag zusammen, und die Sitzung dauerte bis in die Nacht."
    rows = [(1, f"Chapter Three Begins Here\n{PROSE}\n{other}\n{german}"), (2, verse), (3, f"{PROSE} NASA and the EU agreed.\n{other}")]
    found = {r.doc_id: r for r in line_rules.judge_lines(spark.createDataFrame(rows, "doc_id long, text string"), clean=True).collect()}
    assert all(r.kept for r in found.values())
    assert found[1].cleaned == f"{PROSE}\n{other}\n{german}" and found[2].cleaned == verse and found[3].cleaned == rows[2][1]


def test_language_is_learned_and_rejected(spark, docs, edges, no_rows):
    part = remainder(F.col("doc_id"), 3)
    model = language_id.fit(docs.where(part != 1))
    found = language_id.identify(docs, model).join(docs.where(part == 1).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.99
    assert all(0 <= r.score <= 1 for r in found) and not any(r.rejected for r in found)
    odd = {r.doc_id: r for r in language_id.identify(edges, model).where("doc_id IN (1, 2, 3, 10)").collect()}
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in odd.values()) and len(odd) == 4
    strange = spark.createDataFrame([(1, "Привет мир"), (2, "… — ١٢٣"), (3, "Καλημέρα κόσμε, τι κάνεις")], "doc_id long, text string")
    assert {r.doc_id: (r.lang_pred == "und", r.rejected) for r in language_id.identify(strange, model).collect()} == {
        1: (False, True), 2: (True, True), 3: (False, True),
    }
    assert language_id.identify(edges, model).count() == edges.count()
    assert language_id.keep_identified(edges, model).columns == edges.columns
    none = language_id.fit(no_rows)
    assert none is None and {r.lang_pred for r in language_id.identify(edges, none).collect()} == {"und"}
    assert language_id.identify(no_rows, model).count() == 0


def test_quality_separates_held_out_labels(spark, sf, docs, edges, no_rows):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    part = remainder(F.col("doc_id"), 3)
    model = quality.fit(docs, labels.where(part != 1))
    found = quality.rate(docs, model).join(labels.where(part == 1), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.97
    assert sum(r.quality == 1 and not r.predicted for r in found) == 0
    rated = quality.rate(edges, model).collect()
    assert len(rated) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rated)
    assert len({r.score for r in rated if r.doc_id in (1, 2, 3)}) == 1
    none = quality.fit(docs, labels.limit(0))
    assert none is None and {(r.score, r.predicted) for r in quality.rate(edges, none).collect()} == {(0.5, 1)}
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7), (4, 0), (4, 0)], "doc_id long, quality int")
    assert quality.fit(edges, odd) is not None
    assert quality.rate(no_rows, model).count() == 0


def test_bounded_sample_keeps_all_of_a_small_group(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") < 19_900, "many").when(F.col("id") < 19_950, "few").alias("g"))
    counts = {r.g: r["count"] for r in bounded_sample(df, F.col("id"), 100, per=F.coalesce("g", F.lit("none"))).groupBy("g").count().collect()}
    assert counts["few"] == 50 and counts[None] == 50 and 50 < counts["many"] < 200


def test_training_texts_are_bounded_whatever_the_ids(spark):
    """Rows of one id, of no id and equal rows: each model is trained on distinct rows, as many as stated."""
    doc_id = F.when(F.col("id") < 1500, 7).cast("long").alias("doc_id")
    rows = spark.range(6000).select(doc_id, F.concat(F.lit("some words of row "), F.col("id") % 1000).alias("text"), F.lit("xx").alias("lang"))
    few = language_id.training_rows(rows, language_id.LanguageSettings(rows_per_language=300))
    assert 20 <= few.count() <= 450 and few.count() == few.distinct().count()
    named = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, label int")
    some = quality.training_texts(rows.drop("lang"), named, quality.QualitySettings(rows=200))
    assert some.count() == some.distinct().count() == 200


def test_license_scan_equals_sql_and_has_no_python(spark, sf, docs, edges, no_rows, plan_of, entry):
    query = entry["op7_license_scan"](spark, sf)
    assert differences(query, connect(sf), license_scan.scan_sql()) == []
    assert not re.search("Python|Pandas|Arrow", plan_of(query))
    assert {(r.doc_id, r.license) for r in license_scan.scan(edges).collect()} == {(12, "MIT"), (13, "GPL-3.0")}
    assert license_scan.scan(no_rows).count() == 0


NOTICES = {
    "Distributed under the MIT License, as all our tools are": "MIT distributed",
    "The code is licensed under the MIT license, see LICENSE": "MIT licensed",
    "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1": "LGPL notice",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "BSD notice",
    "// SPDX-License-Identifier: GPL-2.0-only\nint main;": "SPDX GPL-2.0",
    "/* This is free and unencumbered software released into the public domain. */": "Unlicense",
    "Released under no license at all, and not under the MIT one": None,
}


def test_notices_beyond_the_fixtures_are_found(spark):
    rows = [(i, t) for i, t in enumerate(NOTICES)]
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    for i, wanted in enumerate(NOTICES.values()):
        assert found.get(i, set()) == ({wanted} if wanted else set()), rows[i]


def test_edited_notice_is_found_by_containment(spark):
    notice = dict(license_scan.TEMPLATES)["GPL-3.0 notice"]
    rows = [(1, "before " * 40 + notice.replace("modify", "change") + " after" * 40), (2, notice.replace("the", "a")), (3, notice[:60])]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("license = 'GPL-3.0 notice'").collect()
    assert [r.doc_id for r in found] == [1] and 0.8 <= found[0].containment < 1


def scored_by_hand(rows, settings):
    """Base scores, and mixture scores with the weights that the operator's own rule learns."""
    tokens = [(*row, [*words(lowered(row[1])), "\0"]) for row in rows]

    def counts(of):
        one, two = Counter(), Counter()
        for *_, role, found in tokens:
            if role in of:
                one.update(found)
                two.update(zip(["\1", *found], found))
        return one, two

    def shares(found, one, two):
        total, texts = sum(one.values()), one["\0"]
        for before, token in zip(["\1", *found], found):
            context = texts if before == "\1" else one[before]
            yield one[token] / max(total, 1), two[before, token] / context if context else 0.0, context

    one, two = counts((ngram_lm.FIT, ngram_lm.TUNE))
    kept = counts((ngram_lm.FIT,))
    bucket = lambda c: c.bit_length()
    step = lambda p: min(126, max(0, round(-4 * np.log2(p)))) if p > 0 else 127
    cells = Counter()
    for *_, role, found in tokens:
        if role == ngram_lm.TUNE:
            cells.update(step(a) | (step(b) << 13) | (bucket(c) << 20) for a, b, c in shares(found, *kept))
    types, total = len(one), sum(one.values())
    keys = np.array(sorted(cells), dtype=np.int64)
    weights = ngram_lm.learn_weights(keys, np.array([cells[k] for k in keys.tolist()], dtype=np.int64), 2, types, settings.rounds)
    out = []
    for doc_id, _, _, found in tokens:
        score = 0.0
        for a, b, c in shares(found, one, two):
            p = weights[0][0] * a + (1 - weights[0][0]) / (types + 1)
            score += log10(weights[1][bucket(c)] * b + (1 - weights[1][bucket(c)]) * p)
        base = sum(log10((one[t] + 1) / (total + types + 1)) for t in found)
        out.append((doc_id, len(found), sum(one[t] > 0 for t in found), total, base, score))
    return out


@pytest.mark.parametrize("size", (8_000_000, 5_000))
def test_scores_equal_plain_python(spark, docs, edges, size):
    settings = ngram_lm.ModelSettings(batch_bytes=size)
    role = F.coalesce(F.pmod("doc_id", F.lit(7)), F.lit(3))
    role = F.when(role == 2, ngram_lm.SCORE).when(role == 5, ngram_lm.TUNE).otherwise(ngram_lm.FIT)
    table = docs.limit(120).select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    wanted = scored_by_hand([tuple(r) for r in table.select("doc_id", "text", role).collect()], settings)
    found = [tuple(r) for r in ngram_lm.score(table, role, settings).collect()]
    order = lambda r: (repr(r[0]), r[1:3], round(r[4], 6))
    found, wanted = sorted(found, key=order), sorted(wanted, key=order)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert np.allclose([r[4:] for r in found], [r[4:] for r in wanted], rtol=1e-9)


def test_held_out_texts_score_better_than_the_base(spark, sf, entry):
    found = entry["op9_ngram_scores"](spark, sf).toPandas()
    held = found[found.held_out]
    assert (held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 7) == 2).all()
    assert held.score.sum() > held.base_score.sum()


def test_scores_without_training_texts(edges, no_rows):
    found = ngram_lm.score(edges, F.lit(None)).collect()
    assert len(found) == len(EDGES) and all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in found)
    assert ngram_lm.score(no_rows, F.lit(ngram_lm.FIT)).count() == 0


def test_longer_orders_use_longer_contexts(docs):
    table, role = docs.limit(60), F.when(F.col("doc_id") % 5 == 0, ngram_lm.TUNE).otherwise(ngram_lm.FIT)
    two, three = (ngram_lm.score(table, role, ngram_lm.ModelSettings(order=n)).agg(F.sum("score")).first()[0] for n in (2, 3))
    assert three > two


def test_keys_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (ngram_lm.unpack_keys(ngram_lm.pack_keys(keys)) == keys).all()


def test_registered_scores_use_trigrams(spark, sf, docs, entry):
    held_out = remainder(F.col("doc_id"), 7) == 2
    tuned = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(8)) == 0
    role = F.when(held_out, ngram_lm.SCORE).when(tuned, ngram_lm.TUNE).otherwise(ngram_lm.FIT)
    wanted = {r.doc_id: r.score for r in ngram_lm.score(docs, role, ngram_lm.ModelSettings(order=3)).collect()}
    found = {r.doc_id: r.score for r in entry["op9_ngram_scores"](spark, sf).collect()}
    assert found.keys() == wanted.keys() and np.allclose([found[i] for i in wanted], list(wanted.values()), rtol=1e-9)


def test_weights_are_learned_alike_where_cells_stand(spark):
    rng = np.random.default_rng(3)
    fields = [rng.integers(0, high, 3000) for high in (128, 1, 128, 20, 128, 20)]
    cells = np.unique(sum(f << at for f, at in zip(fields, (0, 7, 13, 20, 26, 33))))
    numbers = rng.integers(1, 9, len(cells))
    table = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cells, numbers)], "cell long, n long").repartition(3)
    found = ngram_lm.learn_weights_where_they_stand(table, 3, 500, 5)
    assert np.allclose(found, ngram_lm.learn_weights(cells, numbers, 3, 500, 5), rtol=1e-9)


def test_counts_are_packed_without_loss():
    for values in ([], [0, 1, 127], [128], [2**15], [2**31, 5], [2**40]):
        assert ngram_lm._unpacked(ngram_lm._packed(np.array(values, dtype=np.int64))).tolist() == values
