"""Trained operators by held-out accuracy, licence rules by hand, and the pipeline."""

import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import byte_bpe, cotraining, language_id, licences, queries

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_language_of_held_out_texts(corpus):
    found = language_id.identify(corpus).where("held_out AND lang IS NOT NULL").select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97 and len(found) > 100
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_looks_at_the_text_alone(corpus):
    rows = corpus.where("doc_id < 60")
    net = language_id.fit(corpus)
    moved = rows.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "doc_id": F.col("doc_id") + 10 ** 6})
    a, b = (sorted(map(tuple, language_id.with_language(df, net).select("text", "lang_pred", "score").collect()))
            for df in (rows, moved))
    assert a == b


def test_every_language_is_learned(spark):
    alphabets = {f"l{i:02}": [chr(0x4E00 + 16 * i + j) for j in range(8)] for i in range(30)}
    rng = np.random.default_rng(3)
    rows = [(i, lang, "".join(rng.choice([*letters, " "], 200)))
            for i, (lang, letters) in enumerate((k, v) for k, v in alphabets.items() for _ in range(100 if k < "l20" else 3))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    sampled = language_id.labelled_windows(df, "lang", "text", "doc_id", sample=60)
    texts = 60 // len(alphabets)
    assert {r["lang"] for r in sampled} == set(alphabets) and len(sampled) <= 60 * language_id.WINDOWS
    assert max(np.unique([r["lang"] for r in sampled], return_counts=True)[1]) == texts * language_id.WINDOWS
    found = language_id.with_language(df, language_id.fit(df)).select("lang", "lang_pred").collect()
    assert {r["lang_pred"] for r in found} == set(alphabets)
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95


def test_pair_tables_are_the_network(corpus):
    net = language_id.Network(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (50, language_id.WINDOW), dtype=np.uint8)
    values, _ = net.pooled(x)
    want = language_id.softmax(np.maximum(values + net.bias, 0) @ net.dense + net.offset)
    assert np.allclose(language_id.Applied(net).probabilities(x), want, atol=1e-5)


def test_gradients():
    net = language_id.Network(["a", "b", "c"])
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 256, (20, language_id.WINDOW), dtype=np.uint8), rng.integers(0, 3, 20)

    def loss():
        values, _ = net.pooled(x)
        return -np.log(language_id.softmax(np.maximum(values + net.bias, 0).astype(float) @ net.dense + net.offset)[np.arange(20), y]).mean()
    grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-3
        up = loss()
        p[at] = old - 1e-3
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 2e-2 * max(1, abs(g[at]))


def test_a_window_covers_every_place():
    net = language_id.Network(["a"])
    use, seen = language_id.Applied(net), []
    use.probabilities = lambda x: (seen.append(x.copy()), np.ones((len(x), 1)))[1]
    text = "".join(chr(97 + i % 26) for i in range(1000))
    use.languages([text])
    windows = [bytes(w) for w in np.concatenate(seen)]
    for w in language_id.WIDTHS:
        assert all(any(text[i:i + w].encode() in x for x in windows) for i in range(len(text) - w + 1))


def test_quality_agrees_with_the_labels(spark, corpus):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    train, rest = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    scored = cotraining.with_quality(corpus, cotraining.fit(corpus, train)).join(rest, "doc_id")
    rows = scored.select("quality", "keep").collect()
    assert np.mean([r["keep"] == bool(r["quality"]) for r in rows]) > 0.95 and len(rows) > 50


def test_each_view_teaches_the_other():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 3000).astype(float)
    text = np.c_[y + rng.normal(0, 0.25, 3000), rng.normal(0, 1, (3000, 60))]
    page = np.c_[y + rng.normal(0, 0.25, 3000), rng.normal(0, 1, (3000, 60))]
    few, pool, test = slice(0, 60), slice(60, 2000), slice(2000, 3000)

    def accuracy(rounds):
        views = cotraining.co_train(text[few], page[few], y[few], text[pool], page[pool], rounds)
        return [((s[test] if len(s) == 3000 else s) >= 0.5).tolist() for s in
                [views.scores(text[test], page[test])[i] for i in range(3)]]
    before, after = accuracy(0), accuracy(6)
    right = [np.mean(np.array(p) == y[test]) for p in (before[0], after[0], after[2])]
    assert right[1] > right[0] and right[2] >= right[1] - 0.01


def test_the_exchange_covers_all_documents(spark, corpus):
    """The whole exchange on Spark against one in memory, and each answer against a plain sort."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("doc_id % 2 = 0").select("doc_id", "quality")
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] in (0, 1)}
    copies = corpus.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 10 ** 9)
    docs = corpus.unionByName(copies).repartition(11)
    views = cotraining.fit(docs, labels, labelled=120)

    viewed = cotraining._viewed(docs.select(F.col("doc_id").alias("id"), F.lit(None).cast("double").alias("y"),
                                            "text", "source", "lang", "n_chars"))
    rows = [r for r in viewed.collect() if r["id"] not in known]
    text = cotraining._matrix([r["text_view"] for r in rows], cotraining.WIDTH["text"])
    page = cotraining._matrix([r["page_view"] for r in rows], cotraining.WIDTH["page"])
    keys = [r["key"] for r in rows]
    assert len(set(keys)) < len(keys)
    y, own_text, own_page = cotraining._sample(
        viewed.drop("y").join(labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("y")), "id"), 120)
    asked = []

    def ask(question):
        asked.append(question)
        answer = {}
        for side, other, x in (("text", page, text), ("page", text, page)):
            p = question.models[side][1].probability(question.models[side][0].margin(x)[:, None])
            for verdict in (0, 1):
                sure = {}
                for i, k in enumerate(keys):
                    certainty = round(float(p[i] if verdict else 1 - p[i]), cotraining.PLACES)
                    if k not in question.taken and certainty >= question.confident and (p[i] >= 0.5) == bool(verdict):
                        sure.setdefault(k, (-certainty, k, i))
                best = sorted(sure.values())[:question.shares[verdict]]
                answer[side, verdict] = cotraining.Candidates(
                    np.array([k for _, k, _ in best], np.int64), np.array([-c for c, _, _ in best], float),
                    other[[i for _, _, i in best]])
        return answer
    assert len(y) == 120
    plain = cotraining.taught(own_text, own_page, y, ask)
    assert len(asked) > 1 and len(asked[-1].taken) > 20
    for a, b in zip(views.scores(text, page), plain.scores(text, page)):
        assert np.allclose(a, b, atol=1e-6)


def test_repeated_ids_are_one_document(spark, corpus):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    one = corpus.join(labels.limit(1), "doc_id", "left_semi")
    many = one.crossJoin(spark.range(2000).withColumnRenamed("id", "i")).withColumn(
        "text", F.concat("text", F.lit(" "), F.col("i").cast("string"))).drop("i")
    both = corpus.unionByName(many)
    sampled = both.select(F.col("doc_id").alias("id"), F.lit(1.0).alias("y"), "text", "source", "lang", "n_chars")
    y, text, page = cotraining._features(sampled)
    assert len(y) == len(text) == len(page) == corpus.select("doc_id").distinct().count()
    again = cotraining._features(sampled.repartition(7, "text"))
    assert all(np.array_equal(a, b) for a, b in zip((y, text, page), again))


def test_the_sample_is_cut_by_hash_first(spark):
    view = F.lit(bytes(4 * cotraining.WIDTH["text"])), F.lit(bytes(4 * cotraining.WIDTH["page"]))
    rows = spark.range(0, 20_000, 1, 16).select(
        (F.col("id") % 10_000).alias("id"), view[0].alias("text_view"), view[1].alias("page_view"),
        F.col("id").cast("double").alias("y"))
    hashed = rows.select("id", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 40)).alias("h")).distinct().orderBy("h").limit(100)
    want = sorted(r["id"] for r in hashed.collect())
    assert sorted(cotraining._sample(rows, 100)[0]) == want
    assert len(cotraining._sample(rows, 10 ** 6)[0]) == 10_000


def test_labels_that_say_nothing(spark, corpus):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int")
    scored = cotraining.with_quality(corpus, cotraining.fit(corpus, labels))
    assert scored.where("NOT keep").count() == 0


MIT = ("MIT License\n\nCopyright (c) 2020 Someone\n\n" + licences.SENTENCES["mit-grant"].capitalize() + ":\n\n"
       + licences.SENTENCES["mit-notice"].capitalize() + ".\n" + licences.SENTENCES["mit-warranty"].upper() + ".")


@pytest.mark.parametrize("text, names", [
    (MIT, ["MIT"]), ("Before. Licensed under the Apache License, Version 2.0. After.", ["Apache-2.0"]),
    ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", ["CC-BY-NC-4.0", "MIT"]),
    (licences.SENTENCES["mit-warranty"] + ". " + licences.SENTENCES["mit-notice"] + ". " + licences.SENTENCES["mit-grant"], []),
    (licences.SENTENCES["mit-grant"] + "\n" + "filler\n" * 9 + licences.SENTENCES["mit-notice"] + "\n"
     + licences.SENTENCES["mit-warranty"], []),
    ("A licence is not mentioned in this mit license agreement.", []), ("", []), (None, [])])
def test_licences(spark, text, names):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = licences.scan(df).first()
    assert row["licences"] == names
    assert all(m["first"] <= m["last"] for m in row["matches"])


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
CC0 = "To the extent possible under law, Jane Q. Doe has waived all copyright\nand related or neighboring rights to this work."


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(part, width) for part in text.split("\n\n"))


def test_wrapped_licences(spark):
    cases = [
        (wrapped(MIT, 78), ["MIT"]), (wrapped(MIT, 20), ["MIT"]), (BSD, ["BSD-2-Clause"]),
        (BSD.replace("1.", "(1)").replace("2.", "(2)"), ["BSD-2-Clause"]),
        (BSD + NAMES.format("the copyright holder"), ["BSD-2-Clause", "BSD-3-Clause"]),
        (BSD + NAMES.format("Some Firm Inc."), ["BSD-2-Clause", "BSD-3-Clause"]),
        (GPL.format(3), ["GPL-3.0-or-later"]), (GPL.format(2).replace("software:", "software;"), ["GPL-2.0-or-later"]),
        (APACHE, ["Apache-2.0"]), (MPL, ["MPL-2.0"]), (CC0, ["CC0-1.0"]),
        ("Released under\n\nthe MIT License.", []), ("Not released under\nthe MIT License.", [])]
    rows = [("".join(mark + line + "\r\n" for line in text.split("\n")), names)
            for text, names in cases for mark in ("", "# ", " * ", "// ")]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert got == {i: names for i, (_, names) in enumerate(rows)}


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
BOOST = """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)
"""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
AGPL = GPL.format(3).replace("General Public License as", "Affero General Public License as")


def test_more_licences(spark):
    cases = [(ISC, ["ISC"]), (ZLIB, ["Zlib"]), (BOOST, ["BSL-1.0"]), (EPL, ["EPL-2.0"]), (LGPL, ["LGPL-2.1-or-later"]),
             (AGPL, ["AGPL-3.0-or-later"]), ("// SPDX-License-Identifier: Apache-2.0\nint x;", ["Apache-2.0"]),
             ("# SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
             ("SPDX-License-Identifier: unheard-of-1.0", [])]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert got == {i: names for i, (_, names) in enumerate(cases)}


def test_licence_sql_on_wrapped_notices(spark, tmp_path):
    texts = [MIT, BSD, BSD + NAMES.format("the copyright holder"), BSD + NAMES.format("Some Firm Inc."), GPL.format(2),
             GPL.format(3), APACHE, MPL, CC0, ISC, ZLIB, BOOST, EPL, LGPL, AGPL, GPL.format(3) + GPL.format(3),
             "Released under\n\nthe MIT License.", "Neither the name of\n\nA\n\nnor the names of its contributors",
             CC0.replace("Jane", "Jane\n\n"), MIT + "\n" + MIT, ISC + "SPDX-License-Identifier: ISC\n" + ZLIB]
    rows = ["".join(mark + line + end for line in wrapped(text, width).split("\n"))
            for text in texts for width in (15, 40, 1000) for mark, end in (("", "\n"), ("# ", "\r\n"), ("(2) ", "\n"))]
    df = spark.createDataFrame(list(enumerate([*rows, "", None])), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op4_sentence_rules(spark, str(tmp_path)).collect()))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert got == sorted(db.execute(queries.ORACLES["op4_sentence_rules"]).fetchall())
    assert sum(n > 0 for _, _, _, n in got) > len(texts)


def test_a_notice_at_the_end_of_a_very_long_text(spark):
    text = "Some words here. " * 30_000 + "Released under the MIT License."
    row = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["licences"] == ["MIT"] and row["sentences"][0]["position"] == 30_000


def test_pipeline(spark, corpus):
    docs, counts = corpus, [corpus.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        counts.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == corpus.columns
        if name in ("language", "quality", "near_dedup"):
            assert docs.exceptAll(before).count() == 0
    assert counts[0] >= counts[1] > counts[2] > counts[3] and counts[4] == counts[5]
    last = docs.collect()
    assert all(r["decodes"] and 4 * r["n_tokens"] == len(r["ids"]) for r in last)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = corpus_pipeline.quality(spark, corpus, SMALL).join(labels, "doc_id")
    assert good.where("quality = 1").count() >= 0.98 * corpus.join(labels, "doc_id").where("quality = 1").count()


def test_pipeline_on_nothing(spark, corpus):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_unknown_ids_are_an_error(spark):
    df = spark.createDataFrame([(bytearray((10 ** 8).to_bytes(4, "little")),)], "ids binary")
    with pytest.raises(Exception, match="index out of range"):
        byte_bpe.decode(df, corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN).collect()
