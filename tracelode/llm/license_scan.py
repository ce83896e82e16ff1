"""License scan by a trained paragraph classifier, in DataFrame and SQL functions only.

A paragraph is what stands between blank lines; line ends and comment marks inside it are no more than
breaks between words, so a wrapped notice reads like any other. Long paragraphs are judged in
stretches that overlap by half. Features are pairs of neighbouring words, but for pairs of two stop
words; versions are written one way first. A multinomial logistic regression with sparse weights is trained on notices (the templates, whole
and in halves, and licence names in phrases that grant) and on what is none: a bounded sample of the
corpus' own stretches, taken as they come, names in phrases that only mention. A clause that denies a grant is
left out before all this. The labels of
the notices come from how the rows are made, not from the comparison below. A family is predicted where
its odds against the unknown class pass a cut that is calibrated on the rows held out of training.

Each predicted stretch is then compared with the family's templates: one of them must have most of its
pairs there, and most of those that tell it from similar templates of other families. Predictions
without such a template are counted and named as unconfirmed. Only pairs that the model or a template
knows leave the scan; both tables are bounded by the templates and are broadcast.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.llm.common import cut, let

#: Stretches of the corpus that training takes at most, and texts that they are taken from; least hash first.
MAX_SAMPLE, MAX_TEXTS = 4000, 1000
#: Words from one stretch to the next; a stretch has twice as many, so what is shorter lies whole in one.
STEP = 60
#: Share of a template's pairs that a stretch must hold to confirm it.
CONFIRM = 0.8
#: Share of stretches with a notice that the calibration assumes, and of those that only mention one.
RATE = 0.02

#: Weight of the unlabelled sample in the first fit.
DOUBT = 0.05

UNKNOWN = "unknown"
#: No grant: names a text only where no licence does.
RESERVED = "all-rights-reserved"
#: What both BSD licences open with, as a class of its own until the whole document is known: with the third clause
#: anywhere in it the opening is BSD-3-Clause, else BSD-2-Clause.
BSD_OPENING, BSD_TWO, BSD_THREE = "BSD opening", "BSD-2-Clause", "BSD-3-Clause"

# Texts by which licences are granted, each of at most STEP words.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
    ),
    BSD_OPENING: (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    BSD_THREE: (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\")",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "OFL-1.1": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software, to use, study, copy, merge, "
        "embed, modify, redistribute, and sell modified and unmodified copies of the Font Software",
    ),
    RESERVED: ("All rights reserved.",),
}
# Phrases around reserved rights, for training alone.
RESERVING = (
    "All rights reserved.", "Copyright (c) by the authors. All rights reserved.", "All rights reserved by the publisher.",
    "No part may be reproduced. All rights reserved.", "Copyright 2020, all rights reserved worldwide.",
)
# What the licences are called.
NAMES = {
    "MIT": ("MIT License", "MIT Licence"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "OFL-1.1": ("SIL Open Font License, version 1.1", "SIL Open Font License 1.1", "SIL OFL 1.1"),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic License, version 2.0"),
    "EUPL-1.2": ("European Union Public Licence 1.2", "European Union Public Licence, version 1.2"),
    "CDDL-1.0": ("Common Development and Distribution License 1.0", "Common Development and Distribution License, version 1.0"),
}
# The licences of the GNU project by short name, long name and versions.
GNU = (("GPL", "General", ("2", "3")), ("LGPL", "Lesser General", ("2.1", "3")), ("AGPL", "Affero General", ("3",)))
for _short, _long, _versions in GNU:
    for _version in _versions:
        NAMES[f"{_short}-{_version}" if "." in _version else f"{_short}-{_version}.0"] = tuple(
            f"{name}{between}{_version}"
            for name in (f"GNU {_long} Public License", f"GNU {_short}", _short)
            for between in (", version ", " ")
        )
# Phrases that grant by name; tags of licences that have no
# class here; phrases that only mention.
GRANTS = (
    "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.",
    "This software is distributed under the {} terms.", "Made available under {}.", "You may use this file under the {}.",
    "Published under {}.", "This project is covered by the {}.", "The code is provided under the {}; see the file LICENSE.",
    "License: {}", "Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under {}.",
)
TAGS = (
    "SPDX-License-Identifier: {}", "SPDX-License-Identifier: {} OR other", "file name SPDX-License-Identifier: {} import",
)
OTHER_TAGS = ("Beerware", "NTP", "Ruby", "PSF-2.0", "Zend-2.0", "W3C", "OpenSSL", "Vim", "AFL-3.0", "OSL-3.0", "MS-PL", "LPPL-1.3c")
MENTIONS = (
    "the {} forbids this", "our lawyer explained the {} to us",
    "unlike the {} this text says nothing", "see the article about the {}", "what the {} means in court", "the {} and other licences",
    "we spoke about the {} at the meeting", "an article on the history of the {}", "he compared the {} with other texts",
    "many people have never read the {}", "the {} was written long ago", "a lecture about {} and its critics",
)
# Words of which two in a row say nothing.
STOP_WORDS = (
    "a", "all", "an", "and", "any", "are", "as", "at", "be", "by", "can", "do", "for", "from", "has", "have", "he", "if", "in", "is", "it",
    "its", "may", "no", "not", "of", "on", "one", "or", "s", "she", "such", "t", "that", "the", "their", "there", "they", "this", "to",
    "was", "we", "were", "will", "with", "you", "your",
)

FAMILIES = (UNKNOWN, *dict.fromkeys([*TEMPLATES, *NAMES]))


#: The ways to write a version: "version 3", "v. 3", "v3", and "GPLv3", whose last letter but the v is of the name.
VERSION = r"\bversion\b|(?:\b|(?<=[a-z]))v\.?[ \t]*(?=[0-9])"


#: A clause of one line that denies a grant: with what it names, as far as the next stop.
DENIAL = (
    r"\b(?:not|never|nothing|none|neither|cannot|no longer|[a-z]+n['’]t)\b[^.;:\n]{0,60}?"
    r"\b(?:licen[sc]ed|released|distributed|published|provided|available|covered)\s+(?:under|by)\b[^.;]{0,60}"
)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, without clauses of denial; versions are written one way: a v, then the number."""
    low = F.lower(text)
    # What the patterns cannot do without is looked for first, as few texts have it.
    denies = F.contains(low, F.lit("under")) | F.contains(low, F.lit("by"))
    told = F.when(denies & low.rlike("licen[sc]ed|released|distributed|published|provided|available|covered"), F.regexp_replace(low, DENIAL, " ")).otherwise(low)
    plain = F.when(F.contains(low, F.lit("version")) | low.rlike(r"v\.?[ \t]*[0-9]"), F.regexp_replace(told, VERSION, " v ")).otherwise(told)
    return F.array_remove(F.split(plain, r"[^\p{L}\p{N}]+", -1), "")


def tagged() -> list[str]:
    """Families that have an SPDX name."""
    return [f for f in FAMILIES if f not in (UNKNOWN, RESERVED, BSD_OPENING)]


def pair_hash(a: Column, b: Column) -> Column:
    """Hash of two neighbouring words, null where both are stop words."""
    return F.when(~(a.isin(*STOP_WORDS) & b.isin(*STOP_WORDS)), F.xxhash64(a, b))


def pair_hashes(of: Column) -> Column:
    """Hashes of the distinct pairs of a word array."""
    none = F.array().cast("array<long>")

    def pairs(w: Column) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: pair_hash(w[i - 1], w[i]))
        return F.when(F.size(w) > 1, F.array_compact(F.array_distinct(made))).otherwise(none)

    return let(of, pairs)


def paragraphs(text: Column) -> Column:
    """What stands between blank lines, without empty ones."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\n[ \t\r]*\n\s*", -1)
    return F.filter(parts, lambda x: F.trim(x, F.lit(" \t\r\n")) != "")


def texts() -> list[tuple[str, str]]:
    """(family, text) of every template: those above, the names, and SPDX tags."""
    out = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    out += [(f, n) for f, ns in NAMES.items() for n in ns]
    return out + [(f, TAGS[0].format(f)) for f in tagged()]


def template_tests(spark: SparkSession) -> DataFrame:
    """(template, family, test, need, n_tests, h): what a stretch must hold for a template. Test 0 are its
    own pairs; each other test are the pairs that a similar template of another family lacks."""
    rows = spark.createDataFrame(texts(), "family string, template string").select(
        "family", pair_hashes(words(F.col("template"))).alias("pairs")
    )
    listed = [(r["family"], frozenset(r["pairs"])) for r in rows.collect() if r["pairs"]]
    out = []
    for i, (family, pairs) in enumerate(listed):
        tests = [pairs] + [
            t for f, o in dict.fromkeys(listed) if f != family and 2 * len(o & pairs) >= len(pairs) and (t := pairs - o)
        ]
        tests = list(dict.fromkeys(tests))
        for k, test in enumerate(tests):
            out += [(i, family, k, int(-(-CONFIRM * len(test) // 1)), len(tests), h) for h in sorted(test)]
    return spark.createDataFrame(out, "template int, family string, test int, need int, n_tests int, h long")


def sampled_stretches(docs: DataFrame, *, text_col: str = "text", most: int = MAX_SAMPLE, most_texts: int = MAX_TEXTS) -> DataFrame:
    """(w): at most `most` distinct stretches, as word arrays, of at most `most_texts` distinct texts. Hashes
    alone are made distinct and ranked; the bound's number of them is sent to the texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    some = docs.select(F.xxhash64(text).alias("o")).distinct().orderBy("o").limit(most_texts)
    met = docs.select(F.xxhash64(text).alias("o"), text.alias("text")).join(F.broadcast(some), "o")
    each = met.select(F.explode(paragraphs(F.col("text"))).alias("p")).select(words(F.col("p")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("w") - 1) / STEP) - 1).cast("int"))
    stretches = each.where(F.size("w") > 1).select(F.explode(F.transform(starts, lambda i: F.slice("w", i * STEP + 1, 2 * STEP))).alias("w"))
    return stretches.withColumn("o", F.xxhash64("w")).dropDuplicates(["o"]).orderBy("o").limit(most).select("w")


class Model:
    """weights: (h, w) with w an array of one weight for each family; bias by family; cut: the log odds
    against the unknown class from which a family is predicted."""

    def __init__(self, weights: DataFrame, bias: list[float], cut_: float):
        self.weights, self.bias, self.cut = weights, bias, cut_


def training_rows(docs: DataFrame, **options) -> DataFrame:
    """(family, w, own, part): own rows are the corpus'; part 0 is held out of training, a quarter of all rows
    by their hash."""
    spark = docs.sparkSession
    # A name by itself is no notice.
    made = [(f, t) for f, t in texts() if t not in NAMES.get(f, ())]
    made += [(f, g.format(n)) for f, ns in NAMES.items() for n in ns for g in GRANTS]
    made += [(f, t.format(f)) for f in tagged() for t in TAGS]
    made += [(RESERVED, t) for t in RESERVING]
    made += [(UNKNOWN, m.format(n)) for ns in NAMES.values() for n in ns for m in MENTIONS]
    made += [(UNKNOWN, TAGS[0].format(t)) for t in OTHER_TAGS]
    given = spark.createDataFrame(made, "family string, text string").select("family", words(F.col("text")).alias("w"))
    half = F.ceil(F.size("w") / 2).cast("int")
    parts = F.array(F.col("w"), F.slice("w", 1, half), F.slice("w", F.size("w") - half + 1, half))
    quoted = given.select("family", F.explode(F.when(F.size("w") >= 16, parts).otherwise(F.array("w"))).alias("w"), F.lit(False).alias("own"))
    rows = quoted.union(sampled_stretches(docs, **options).select(F.lit(UNKNOWN), "w", F.lit(True)))
    return rows.withColumn("part", F.pmod(F.xxhash64("w"), F.lit(4)))


def _fitted(table: DataFrame, own: float = 1.0):
    """A regression over `table` (family, own, label, features, n) in which every family weighs the same,
    however many rows it has; the mentions count as a family, and the corpus' stretches as `own` of one."""
    kind = F.concat(F.col("family"), F.when(F.col("own"), "+").otherwise(""))
    sums = {r["kind"]: r["n"] for r in table.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n")).collect()}
    share = F.element_at(F.create_map(*[x for f, n in sums.items() for x in (F.lit(f), F.lit((own if f.endswith("+") else 1.0) / n))]), kind)
    regression = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=1e-4, elasticNetParam=0.5, maxIter=80, standardization=False
    )
    return regression.fit(table.select("label", "features", (share * F.col("n")).alias("weight")).coalesce(1))


def _margin() -> Column:
    """Log odds of the likeliest family against the unknown class, of a regression's rows."""
    raw = vector_to_array("rawPrediction")
    return F.array_max(F.slice(raw, 2, len(FAMILIES))) - F.get(raw, F.lit(0))


def train(docs: DataFrame, *, text_col: str = "text", rate: float = RATE, **options) -> Model:
    """Fits on the templates and a bounded sample of stretches of `docs`, and calibrates on held-out rows.

    The sample is unlabelled and holds notices of its own, maybe the same one in a third of all texts. A
    first fit takes all of it as unknown, but with little weight; what that fit finds likelier than not
    to be a notice is left out of the second and of the calibration."""
    spark = docs.sparkSession
    rows = training_rows(docs, text_col=text_col, **options)
    rows = cut(rows.select("family", "own", "part", F.transform(pair_hashes(F.col("w")), lambda h: h.cast("string")).alias("g")))
    # Features: all pairs of the notices' rows, whose number the templates bound.
    features = sorted(r["h"] for r in rows.where(F.col("family") != UNKNOWN).select(F.explode("g").alias("h")).distinct().collect())
    counter = CountVectorizerModel.from_vocabulary(features, inputCol="g", outputCol="features", binary=True)
    # Rows that are alike in all features are one row of their number's weight.
    listed = spark.createDataFrame([(h,) for h in features], "h string")
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    numbered = cut(numbered)
    known = (
        numbered.select("row", F.explode("g").alias("h")).join(F.broadcast(listed), "h").groupBy("row").agg(F.array_sort(F.collect_set("h")).alias("k"))
    )
    merged = numbered.join(known, "row", "left").withColumn("g", F.coalesce("k", F.array().cast("array<string>")))
    alike = merged.groupBy("family", "own", "part", "g").agg(F.count(F.lit(1)).cast("double").alias("n"))
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("double") - 1
    table = cut(counter.transform(alike.withColumn("label", label)))
    first = _fitted(table.where("part <> 0"), DOUBT)
    left = first.transform(table).where(~F.col("own") | (_margin() <= 0)).select(*table.columns)
    table = cut(left)
    fitted = _fitted(table.where("part <> 0"))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()

    # Families beyond the last label of the fit have no weights, and a bias that rules them out.
    def of(values, k: int, none: float) -> float:
        return float(values[k]) if k < len(values) else none

    weights = [(int(h), [of(matrix[:, i], k, 0.0) for k in range(len(FAMILIES))]) for i, h in enumerate(features)]
    held = cut(
        fitted.transform(table.where("part = 0")).select((F.col("family") != UNKNOWN).cast("double").alias("label"), "own", _margin().alias("m"), "n")
    )
    n = {(r["label"], r["own"]): r["n"] for r in held.groupBy("label", "own").agg(F.sum("n").alias("n")).collect()}
    passed = 0.0
    if (1.0, False) in n and len(n) > 1:
        # Made rows are as many as there are phrases: what mentions or denies a licence is taken to be as rare as a notice.
        assumed = F.when(F.col("label") == 1, rate / n[1.0, False]).when(F.col("own"), (1 - 2 * rate) / n.get((0.0, True), 1.0))
        assumed = assumed.otherwise(rate / n.get((0.0, False), 1.0))
        scale = LogisticRegression(weightCol="weight", regParam=1e-4).fit(
            held.select("label", array_to_vector(F.array("m")).alias("features"), (assumed * F.col("n")).alias("weight"))
        )
        slope = float(scale.coefficients[0])
        passed = -float(scale.intercept) / slope if slope > 0 else 0.0
    table = spark.createDataFrame([(h, w) for h, w in weights if any(w)], "h long, w array<double>")
    return Model(cut(table), [of(bias, k, -50.0) for k in range(len(FAMILIES))], passed)


def predicted(found: Column, model: Model) -> Column:
    """Families whose odds against the unknown class pass the cut, the likeliest first."""
    start = F.array(*map(F.lit, model.bias))
    sums = F.aggregate(found, start, lambda a, x: F.zip_with(a, x["w"], lambda p, q: p + q))
    names = F.array(*map(F.lit, FAMILIES))
    over = lambda s: F.transform(s, lambda x, k: F.struct((F.get(s, F.lit(0)) - x).alias("odds"), F.get(names, k).alias("family")))
    listed = F.filter(let(sums, over), lambda x: (x["family"] != UNKNOWN) & (x["odds"] <= -model.cut))
    chosen = F.transform(F.array_sort(listed), lambda x: x["family"])
    return F.when(F.size(found) > 0, chosen).otherwise(F.array().cast("array<string>"))


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key (MD5), license (the family with most confirmed notices, ties
    by name, reserved rights after all licences; null without one), families (confirmed ones, in order),
    n_paragraphs, n_confirmed (notices: neighbouring stretches of one family are one), n_unconfirmed
    (stretches predicted, with no confirmed one of any family in them or beside them), unconfirmed
    (the likeliest families of those, in order).

    Null text has no paragraphs; null ids stay; repeated rows each give a row; an empty table gives an
    empty one; other columns are ignored. Without `model` one is trained on these rows.
    """
    spark = docs.sparkSession
    model = model or train(docs, text_col=text_col)
    tests = cut(template_tests(spark))
    lookup = cut(
        model.weights.join(tests.select("h").distinct().withColumn("pair", F.lit(True)), "h", "full").select(
            F.col("h").alias("l_h"), "w", F.coalesce("pair", F.lit(False)).alias("pair")
        )
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.md5(text).alias("text_key"), paragraphs(text).alias("parts"))
    base = base.withColumn("n_paragraphs", F.size("parts"))
    # Paragraph 0 stands for the document, so that none is lost. Outer, though never empty: the plain
    # form adds a filter that splits the text once more.
    each = base.select("doc_id", "text_key", "n_paragraphs", F.posexplode_outer(F.concat(F.array(F.lit("")), "parts")).alias("para", "part"))
    each = each.select("doc_id", "text_key", "n_paragraphs", "para", words(F.col("part")).alias("of"))
    last = F.greatest(F.size("of") - 1, F.lit(0))
    each = each.select("doc_id", "text_key", "n_paragraphs", "para", "of", F.explode_outer(F.sequence(F.lit(0), last)).alias("i"))
    h = F.when(F.col("i") > 0, pair_hash(F.get("of", F.col("i") - 1), F.get("of", F.col("i"))))
    grams = each.select("doc_id", "text_key", "n_paragraphs", "para", "i", h.alias("h"))
    own = (F.col("para") == 0) & (F.col("i") == 0)
    met = grams.join(F.broadcast(lookup), F.col("h") == F.col("l_h"), "left").where(F.col("l_h").isNotNull() | own)
    at = F.floor(F.col("i") / STEP).cast("int")
    spread = met.withColumn("at", F.explode(F.when(at > 0, F.array(at - 1, at)).otherwise(F.array(at))))
    stretches = spread.groupBy("doc_id", "text_key", "para", "at").agg(
        F.max("n_paragraphs").alias("n_paragraphs"),
        F.count(F.when(F.col("para") == 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("w").isNotNull(), F.struct("h", "w"))).alias("found"),
        F.collect_set(F.when(F.col("pair"), F.col("h"))).alias("have"),
    )
    judged = stretches.withColumn("predicted", predicted(F.col("found"), model)).drop("found")
    judged = cut(judged.where((F.col("para") == 0) | (F.size("predicted") > 0)))
    # The comparison: few stretches are left.
    keys = ["doc_id", "text_key", "para", "at"]
    asked = judged.where("para > 0").select(*keys, "predicted", F.explode("have").alias("h"))
    hits = asked.join(F.broadcast(tests), "h").where(F.array_contains("predicted", F.col("family")))
    test = ["template", "family", "test", "need", "n_tests"]
    passed = hits.groupBy(*keys, *test).agg(F.count(F.lit(1)).alias("n")).where("n >= need")
    whole = passed.groupBy(*keys, "template", "family", "n_tests").agg(F.count(F.lit(1)).alias("n")).where("n = n_tests")
    place = F.struct("para", "at")
    none = F.lit(None)
    rows = judged.where("para = 0").select(
        "doc_id", "text_key", "n_paragraphs", "copies", none.cast("struct<family:string,para:int,at:int>").alias("sure"),
        none.cast("struct<para:int,at:int,family:string>").alias("guess"),
    )
    sure = whole.select(
        "doc_id", "text_key", none.cast("int"), none.cast("long"), F.struct("family", "para", "at"), none.cast("struct<para:int,at:int,family:string>")
    )
    guess = judged.where("para > 0").select(
        "doc_id", "text_key", none.cast("int"), none.cast("long"), none.cast("struct<family:string,para:int,at:int>"),
        F.struct("para", "at", F.get("predicted", F.lit(0)).alias("family")),
    )
    gathered = rows.union(sure).union(guess).groupBy("doc_id", "text_key").agg(
        F.max("n_paragraphs").cast("long").alias("n_paragraphs"),
        F.max("copies").alias("copies"),
        F.collect_set("sure").alias("sure"),
        F.collect_set("guess").alias("guess"),
    )
    # The opening of a BSD licence takes its name from the whole document.
    opening = F.when(F.exists("sure", lambda x: x["family"] == BSD_THREE), BSD_THREE).otherwise(BSD_TWO)
    called = lambda x: F.when(x["family"] == BSD_OPENING, opening).otherwise(x["family"]).alias("family")
    gathered = gathered.withColumns({
        "sure": F.array_distinct(F.transform("sure", lambda x: F.struct(called(x), x["para"].alias("para"), x["at"].alias("at")))),
        "guess": F.transform("guess", lambda x: F.struct(x["para"].alias("para"), x["at"].alias("at"), called(x))),
    })
    # The first stretch of each run of neighbours stands for the notice.
    before = lambda x: F.struct(x["family"].alias("family"), x["para"].alias("para"), (x["at"] - 1).alias("at"))
    firsts = F.transform(F.filter("sure", lambda x: ~F.array_contains("sure", before(x))), lambda x: x["family"])
    near = lambda x: F.exists("sure", lambda s: (s["para"] == x["para"]) & (F.abs(s["at"] - x["at"]) <= 1))
    told = gathered.withColumns({"all_": firsts, "loose": F.filter("guess", lambda x: ~near(x))})
    counts = F.transform(
        F.array_distinct("all_"), lambda f: F.named_struct(F.lit("late"), f == RESERVED, F.lit("n"), -F.size(F.filter("all_", lambda x: x == f)), F.lit("f"), f)
    )
    return told.select(
        "doc_id",
        "text_key",
        F.array_min(counts)["f"].alias("license"),
        F.array_join(F.array_sort(F.array_distinct("all_")), ",").alias("families"),
        "n_paragraphs",
        F.size("all_").cast("long").alias("n_confirmed"),
        F.size("loose").cast("long").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.col("loose.family"))), ",").alias("unconfirmed"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
