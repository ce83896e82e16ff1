"""Toxicity, licences, decontamination and address filter."""

from __future__ import annotations

import random
import re
import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelode.llm import license_scan, toxicity
from tracelode.llm.decontaminate import contamination, decontaminated
from tracelode.llm.queries import URL_RULES
from tracelode.llm.url_filter import judged_urls, url_filter_sql


# Toxicity


def biased(n=600, seed=1):
    """Toxic sentences name a group far more often than others do."""
    rnd = random.Random(seed)
    lists, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = {f"w{rnd.randrange(60)}" for _ in range(12)}
        if toxic and rnd.random() < 0.8:
            words.add(rnd.choice(["idiot", "scum"]))
        if rnd.random() < (0.9 if toxic else 0.1):
            words.add("muslims" if rnd.random() < 0.8 else "women")
        lists.append(sorted(words))
        labels.append(int(toxic))
    return lists, np.array(labels)


def test_swaps_take_the_weight_of_groups():
    lists, labels = biased()
    free = toxicity.fit_lists(lists, labels, fairness=0.0)
    fair = toxicity.fit_lists(lists, labels, fairness=50.0)
    neutral = "many muslims live here"
    other = "many christians live here"

    def gap(model):
        return abs(model.score(neutral) - model.score(other))

    assert gap(fair) < 0.5 * gap(free)
    assert fair.score("you idiot scum") > 0.9
    assert fair.score(neutral) < free.score(neutral)


def test_scores_equal_a_plain_loop_over_the_model():
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("gut", "schön", "idiot", "muslim", "x") for b in ("", "er", "s", "ly")]
    model = toxicity.Model({f: rnd.uniform(-2, 2) for w in words for f in toxicity.features(w) if rnd.random() < 0.6}, -0.3)
    scorer = toxicity.Scorer(model, most=5)
    for _ in range(200):
        text = " ".join(rnd.choice(words).upper() if rnd.random() < 0.2 else rnd.choice(words) for _ in range(rnd.randrange(8))) + rnd.choice(["", "!", " 12"])
        margin = model.bias
        for w in {"".join(c for c in part) for part in re.findall(r"[^\W\d_]+", text.lower())}:
            margin += sum(v for f, v in model.weights.items() if f == w or (f[0] == "^" and len(f) - 1 < len(w) and len(f) - 1 in (3, 4, 5, 6) and w.startswith(f[1:])))
        want = 1 / (1 + np.exp(-margin))
        assert abs(scorer(text) - want) < 1e-9 and abs(model.score(text) - want) < 1e-9


def test_the_fit_reaches_the_least_of_its_loss():
    """A plain gradient loop over the same loss, penalty and all, finds no better weights."""
    lists, labels = biased(n=240)
    sentences = ["muslims", "muslims women", "women"]
    model = toxicity.fit_lists(lists, labels, sentences, fairness=3.0, lasso=0.0, rounds=3000, least_z=2.5)
    free = toxicity.fit_lists(lists, labels, sentences, fairness=0.0, lasso=0.0, rounds=3000, least_z=2.5)
    names = sorted(set(model.weights) | set(free.weights))
    count = lambda words: np.array([sum(f in toxicity.features(w) for w in words) for f in names], float)
    x = np.array([count(words) for words in lists])
    rows, mass = [], []
    for group in (sentences, toxicity.generated()):
        made = [(a, b, b in t.split()) for t in group for a in t.split() for b in toxicity.SWAPS[a]]
        rows += [count([a]) - (0 if there else count([b])) for a, b, there in made]
        mass += [0.5 / len(made)] * len(made)
    change, mass = np.array(rows), np.array(mass)
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())

    def loss(w, b):
        m = x @ w + b
        return (weight * (np.logaddexp(0, m) - labels * m)).sum() + 3.0 * (mass * (change @ w) ** 2).sum()

    w, b = np.zeros(len(names)), 0.0
    for _ in range(20000):
        e = weight * (1 / (1 + np.exp(-(x @ w + b))) - labels)
        w -= 0.02 * (x.T @ e + 6.0 * change.T @ (mass * (change @ w)))
        b -= 0.02 * e.sum()
    # The model's margins are the fit's up to its calibration: a scale and an offset.
    ours = np.array([model.weights.get(f, 0.0) for f in names])
    best = min(loss(g * ours, o) for g in np.linspace(0.2, 3, 141) for o in np.linspace(-6, 6, 121))
    assert best < loss(w, b) + 0.01
    assert max(toxicity.gaps(model)) < 0.2 * max(toxicity.gaps(free))


def test_generated_sentences_bind_names_that_no_label_has():
    """A word that begins like a group's name is toxic here; without swaps the name would be too."""
    rnd = random.Random(5)
    lists = [sorted({f"w{rnd.randrange(50)}" for _ in range(9)} | ({"transgression", "disablement"} if i % 3 == 0 else set())) for i in range(300)]
    labels = np.array([int(i % 3 == 0) for i in range(300)])
    free, fair = (toxicity.fit_lists(lists, labels, fairness=f) for f in (0.0, toxicity.FAIRNESS))
    text = "my neighbour is transgender"
    assert free.score(text) - free.score("my neighbour is male") > 0.05
    assert abs(fair.score(text) - fair.score("my neighbour is male")) < 0.005
    assert fair.score("transgression disablement") > 0.8


def test_every_swap_of_a_labelled_sentence_counts():
    assert toxicity.named_groups("The Muslims came. Nobody else! gay women and men\nfin") == ["muslims", "gay men women"]
    found = toxicity.swaps(["gay women"])
    assert found[("women", "girls", False)] == 1 and found[("gay", "straight", False)] == 1 and ("women", "people", False) in found
    assert all(b in toxicity.SWAPS[a] for a, b, _ in found)


def test_conflicting_labels_and_repeated_ids(spark):
    docs = spark.createDataFrame([(i, f"idiot w{i % 7}" if i % 2 else f"fine w{i % 7}") for i in range(60)] + [(1, "idiot again")] * 50, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (1, 1), (None, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, marks, usable=F.lit(True), most=(100, 100))
    assert rows.where("doc_id = 1").count() == 2 and rows.count() == 61
    assert rows.select("doc_id", "toxic").distinct().count() == 61
    assert toxicity.toxicity(docs, marks).count() == 110


def test_held_out_accuracy(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        words = [f"w{rnd.randrange(300)}" for _ in range(60)] + ([rnd.choice(["idiot", "scum", "Loser"])] * 2 if bad else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words), 5.0))
        labels.append((i, int(bad)))
    rows += [(9000, None, 1.0), (9001, "", 1.0), (None, "idiot scum", 1.0), (5, rows[5][1], 1.0), (9002, "w1 " * 60000 + "idiot scum loser", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (4, None), (7, 0), (7, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    want = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 200
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.98
    by = {r.doc_id: r for r in got}
    assert by[9002].predicted == 1
    assert by[9001].score == by[9000].score
    assert all(0 <= r.score <= 1 for r in got)
    kept = toxicity.clean_documents(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)
    none = toxicity.toxicity(docs, marks.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0


def test_a_repeated_id_is_one_training_row(spark):
    docs = spark.createDataFrame([(1, f"t{i % 2}") for i in range(50)] + [(2, "b"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, marks, usable=F.lit(True), most=(5, 5)).collect()
    assert sorted((r.doc_id, r.toxic) for r in rows) == [(1, 1), (2, 0), (3, 0)]


# Licences


def prose(rnd, n=30):
    return " ".join(rnd.choice("the of and that this is in on under version work code free mere river stone".split()) for _ in range(n))


@pytest.fixture(scope="module")
def licence_model(spark):
    rnd = random.Random(5)
    rows = [(i, "\n\n".join(prose(rnd) for _ in range(3))) for i in range(300)]
    rows += [(1000 + i, prose(rnd) + "\nReleased under the MIT License.\n" + prose(rnd)) for i in range(150)]  # a third of all texts
    return license_scan.train(spark.createDataFrame(rows, "doc_id long, text string"))


def scanned(spark, model, rows):
    docs = spark.createDataFrame([(r[0], r[1], 1) for r in rows], "doc_id long, text string, w int")
    return license_scan.license_scan(docs, model=model).collect()


def test_licences(spark, licence_model):
    rnd = random.Random(6)
    mit, gpl = "Licensed under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(i, prose(rnd) + "\n\n" + prose(rnd), None) for i in range(50)]
    rows += [(1000 + i, prose(rnd) + "\n" + mit + " " + prose(rnd) + "\n" + prose(rnd), "MIT") for i in range(5)]
    rows += [(2000 + i, gpl.upper() + "\r\n" + prose(rnd), "GPL-3.0") for i in range(5)]
    rows += [(3000, None, None), (3001, "", None), (3002, "the licence of this work is under no licence", None), (None, mit, "MIT"), (1000, rows[50][1], "MIT")]
    rows += [(3003, prose(rnd) + " x" * 30000 + "\n" + mit, "MIT"), (3004, "\n \n".join([mit, gpl, mit + "\n"]), "MIT")]
    got = scanned(spark, licence_model, rows)
    assert sorted((str(r.doc_id), str(r.license)) for r in got) == sorted((str(a), str(c)) for a, _, c in rows)
    both = next(r for r in got if r.doc_id == 3004)
    assert (both.families, both.n_confirmed, both.n_paragraphs) == ("GPL-3.0,MIT", 3, 3)
    assert scanned(spark, licence_model, rows[:1])[0].n_unconfirmed == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.license_scan(empty).count() == 0


def test_wrapped_tagged_and_paraphrased_notices(spark, licence_model):
    """None of these texts is a template's."""
    rnd = random.Random(7)
    forms = [("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-2.0", "GPL-2.0")]
    forms += [("distributed under the MIT license terms", "MIT"), ("You may copy this file under the Apache License 2.0, see LICENSE", "Apache-2.0")]
    forms += [("this library is published under the GNU Lesser General Public License, version 3", "LGPL-3.0")]
    rows = [(i, prose(rnd, 40) + "\n" + text + "\n" + prose(rnd, 40), f) for i, (text, f) in enumerate(forms)]
    for k, (family, all_) in enumerate(license_scan.TEMPLATES.items()):
        family = "BSD-2-Clause" if family == license_scan.BSD_OPENING else family
        for j, notice in enumerate(all_):
            for width in (30, 76):
                wrapped = textwrap.wrap(notice, width)
                rows.append((1000 + 100 * k + 10 * j + width % 7, "\n".join([prose(rnd), *wrapped, prose(rnd)]), family))
                rows.append((9000 + 100 * k + 10 * j + width % 7, "\n".join([prose(rnd, 200), "", *(" * " + x for x in wrapped), "", prose(rnd)]), family))
    for k, (family, names) in enumerate(license_scan.NAMES.items()):
        rows += [(20000 + 10 * k + j, prose(rnd) + "\nThis text is made available under the " + name + ".\n", family) for j, name in enumerate(names)]
    got = scanned(spark, licence_model, rows)
    wrong = {(r.doc_id, str(r.license)) for r in got} ^ {(a, str(c)) for a, _, c in rows}
    assert not wrong
    assert {r.n_confirmed for r in got} == {1}


OPENING, CLAUSE = license_scan.TEMPLATES[license_scan.BSD_OPENING][0], license_scan.TEMPLATES["BSD-3-Clause"][0]
HARD = [
    (OPENING + ":\n1. Redistributions of source code must retain the above copyright notice.", "BSD-2-Clause"),
    (OPENING + "\n\n" + CLAUSE, "BSD-3-Clause"),
    (CLAUSE + "\n\nriver\n\n" + OPENING, "BSD-3-Clause"),
    ("Licensed under the GNU General Public License v3.0", "GPL-3.0"),
    ("This is released under GPLv3.", "GPL-3.0"),
    ("distributed under the terms of the LGPL v2.1", "LGPL-2.1"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
    ("SPDX-License-Identifier: Artistic-2.0", "Artistic-2.0"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below", "OFL-1.1"),
    ("It is free to use under the terms of the Mozilla Public License v2.0", "MPL-2.0"),
    ("licensed under Apache License v2.0, see NOTICE", "Apache-2.0"),
    ("Not licensed under the MIT License.", None),
    ("we do not use code which is licensed under the Apache License, Version 2.0", None),
    ("This program is never released under the GNU General Public License, version 3", None),
    ("The tool isn't distributed under the terms of the MIT License", None),
    ("The files are no longer licensed under the ISC License", None),
    ("Not licensed under the MIT License. Released under the ISC License.", "ISC"),
    ("it is not easy\nReleased under the MIT License", "MIT"),
    ("SPDX-License-Identifier: LPPL-1.3c", None),
]


def test_versions_denials_and_what_tells_bsd_licences_apart(spark, licence_model):
    got = {r.doc_id: r for r in scanned(spark, licence_model, [(i, t) for i, (t, _) in enumerate(HARD)])}
    assert [got[i].license for i in range(len(HARD))] == [w for _, w in HARD]
    # Openings and clause are one licence, whose notices are counted as they stand.
    assert (got[1].families, got[1].n_confirmed, got[0].families, got[0].n_confirmed) == ("BSD-3-Clause", 2, "BSD-2-Clause", 1)


def test_a_mention_is_no_notice_and_an_unlike_notice_is_unconfirmed(spark, licence_model):
    rnd = random.Random(8)
    rows = [(1, prose(rnd) + "\nwe spoke about the history of the MIT License at the meeting\n" + prose(rnd))]
    rows += [(2, prose(rnd) + "\nThis software is licensed under the terms of the Public License, distributed under the license terms.\n" + prose(rnd))]
    got = {r.doc_id: r for r in scanned(spark, licence_model, rows)}
    assert got[1].license is None and got[1].n_confirmed == 0 and got[1].n_unconfirmed == 0
    assert got[2].license is None and got[2].n_unconfirmed == 1 and got[2].unconfirmed in license_scan.FAMILIES


def test_reserved_rights_name_a_text_only_without_a_licence(spark, licence_model):
    rows = [(1, "Copyright X. All rights reserved."), (2, "All rights reserved.\n\nReleased under the MIT License.\n\nCopyright Y. All rights reserved.")]
    rows += [(3, "no rights are kept here, all the rights were given away")]
    got = {r.doc_id: r for r in scanned(spark, licence_model, rows)}
    assert (got[1].license, got[2].license, got[3].license) == (license_scan.RESERVED, "MIT", None)
    assert got[2].families == "MIT," + license_scan.RESERVED and got[2].n_confirmed == 3


def test_scan_equals_a_plain_loop(spark, licence_model):
    """Stretches, odds, comparison and counts by loops over the model's weights and the templates."""
    rnd = random.Random(9)
    bits = [t for _, t in license_scan.texts()] + ["under the license", "free software", "general public", "version 2"]
    rows = [(i, "".join(rnd.choice([prose(rnd, rnd.randrange(1, 90)), rnd.choice(bits)]) + rnd.choice([" ", "\n", "\n\n"]) for _ in range(rnd.randrange(1, 9)))) for i in range(120)]
    weights = {r.h: np.array(r.w) for r in licence_model.weights.collect()}
    bias = np.array(licence_model.bias)
    tests: dict = {}
    for r in license_scan.template_tests(spark).collect():
        tests.setdefault((r.template, r.family), {}).setdefault(r.test, (r.need, set()))[1].add(r.h)
    plain = lambda p: re.sub(license_scan.VERSION, " v ", re.sub(license_scan.DENIAL, " ", p.lower()))
    split = [[[w for w in re.split(r"[\W_]+", plain(p)) if w] for p in re.split(r"\n[ \t\r]*\n\s*", text) if p.strip(" \t\r\n")] for _, text in rows]
    couples = sorted({(a, b) for doc in split for w in doc for a, b in zip(w, w[1:], strict=False)})
    hashed = spark.createDataFrame(couples, "a string, b string").select("a", "b", license_scan.pair_hash(F.col("a"), F.col("b")).alias("h"))
    h_of = {(r.a, r.b): r.h for r in hashed.collect()}
    got = {r.doc_id: r for r in scanned(spark, licence_model, rows)}
    for (i, _), doc in zip(rows, split, strict=True):
        sure, guess = set(), set()
        for p, w in enumerate(doc, 1):
            for at in range(len(w) // license_scan.STEP + 1):
                lo, hi = at * license_scan.STEP, (at + 2) * license_scan.STEP
                have = {h_of[w[k - 1], w[k]] for k in range(max(lo, 1), min(hi, len(w)))} - {None}
                if not have & weights.keys():
                    continue
                s = bias + sum(weights[h] for h in have & weights.keys())
                families = {license_scan.FAMILIES[k] for k in range(1, len(s)) if s[k] - s[0] >= licence_model.cut}
                if families:
                    guess.add((p, at))
                for (_, family), each in tests.items():
                    if family in families and all(len(have & hs) >= need for need, hs in each.values()):
                        sure.add((family, p, at))
        three = any(f == "BSD-3-Clause" for f, _, _ in sure)
        sure = {(("BSD-3-Clause" if three else "BSD-2-Clause") if f == license_scan.BSD_OPENING else f, p, at) for f, p, at in sure}
        firsts = [f for f, p, at in sure if (f, p, at - 1) not in sure]
        loose = [g for g in guess if not any(g[0] == p and abs(g[1] - at) <= 1 for _, p, at in sure)]
        assert (got[i].n_paragraphs, got[i].families, got[i].n_confirmed, got[i].n_unconfirmed) == (len(doc), ",".join(sorted(set(firsts))), len(firsts), len(loose)), i


# Decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(text, items):
    doc, hit, found = words(text), set(), set()
    for i, item in items:
        if i is None:
            continue
        w = words(item)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for p in range(len(doc) - n + 1):
                if doc[p : p + n] == w[k : k + n]:
                    hit.update(range(p, p + n))
                    found.add(i)
    return len(doc), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(doc)


def contaminated_case(spark):
    rnd = random.Random(6)
    take = lambda n: [f"t{rnd.randrange(40)}é" for _ in range(n)]
    long_, other, short = take(30), take(13), take(4)
    items = [(1, " ".join(long_)), (2, ", ".join(other).upper().replace("É", "é")), (3, " ".join(short)), (4, None), (5, " .. "), (10, " ".join(long_[5:25])), (None, "x y")]
    texts = [
        None, "", " . ", " ".join(long_), " ".join(take(50) + long_[3:20] + take(700)), "-".join(take(5) + short + take(5) + short + take(300)),
        " ".join(other[:12]), " ".join(other * 3), " ".join(take(40000)), " ".join(long_[:13] + long_), "x y",
    ]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(3, texts[3], "c"), (None, texts[7], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string")
    return rows, items, docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("broadcast", [10_000_000, 0])
def test_contamination(spark, broadcast):
    rows, items, docs, bench = contaminated_case(spark)
    got = contamination(docs, bench, max_broadcast=broadcast).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.contaminated) for r in got) == sorted(
        (str(i), *slow(t, items)) for i, t, _ in rows
    )
    kept = decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t, _ in rows if not slow(t, items)[3])


def test_contamination_of_empty_tables(spark):
    _, _, docs, bench = contaminated_case(spark)
    for most in (10_000_000, 0):
        assert contamination(docs.limit(0), bench, max_broadcast=most).count() == 0
        assert {r.n_hit for r in contamination(docs, bench.limit(0), max_broadcast=most).collect()} == {0}


def test_a_window_of_very_many_items_and_a_very_common_word(spark):
    """Neither the broadcast nor the exchange gathers a window's items; a one-word item is a hot hash."""
    items = [(f"i{i}", "the") for i in range(300)] + [("z", "one two three")]
    docs = spark.createDataFrame([(i, "the " * 200 + ("one two three" if i == 3 else "")) for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    for most in (10_000_000, 0):
        got = {r.doc_id: r for r in contamination(docs, bench, max_broadcast=most).collect()}
        assert len(got) == 40 and got[0].n_hit == 200 and got[3].n_hit == 203
        assert got[0]["items"] == sorted(f"i{i}" for i in range(300)) and got[3].n_items == 301


# Addresses


def pages(spark):
    rnd = random.Random(7)
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org", "http://a.example.org/es/1?x=/en/1", "x://example.org/en/12#f", "http://org/a", "http://notexample.org/es/1"]
    urls += ["http://a.com/fr/", "http://a.com/de/9?q", "http://com/fr/x", "http://a.com:80/fr/", "http://é.ORG/x://y/z", "http://b.net/" + "a/" * 50 + "end", "http://b.net//*/ 1"]
    for _ in range(900):
        urls.append(f"https://h{rnd.randrange(4)}.{rnd.choice(['com', 'net'])}/{rnd.choice(['fr', 'de', 'en', 'es', 'shop'])}/{rnd.choice(['a', 'b'])}{rnd.randrange(5000)}.html")
    for i in range(60):
        urls.append(f"https://slug.com/{'de' if i % 2 else 'x'}/{''.join(rnd.choice('abcdef') for _ in range(9))}/end")
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(3, "http://", "h"), (None, "http://a.com/de/9?q", "h")]
    return spark.createDataFrame(rows, "page_id long, url string, host string")


def test_addresses_equal_sql(spark):
    df = pages(spark)
    got = judged_urls(df, URL_RULES).toArrow()
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url").toArrow())
    want = con.sql(url_filter_sql(URL_RULES)).to_arrow_table()
    names = sorted(got.column_names)
    key = lambda t: sorted(tuple(str(r[n]) for n in names) for r in t.select(names).to_pylist())
    assert key(got) == key(want)
    by = {r["page_id"]: r for r in got.to_pylist()}
    assert by[5]["rule"] == "example.org/es/" and by[5]["verdict"] == "block"
    assert by[6]["rule"] == "example.org/en/1"
    assert by[8]["rule"] == "org/"
    assert by[4]["host"] == "example.org" and by[4]["path"] == "" and by[4]["rule"] is None
    assert by[12]["host"] == "a.com:80" and by[12]["rule"] is None
    assert len(got) == df.count()


def test_templates_reject(spark):
    rows = [(i, f"https://bad.com/{i % 9}/de/{i}") for i in range(300)]
    rules = [r._replace(path="/1/", verdict="block") for r in URL_RULES[-1:]]
    rows += [(1000 + i, f"https://fine.net/{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in judged_urls(df, rules).collect()}
    assert got[1].rule == "com/1/"
    assert got[2].rule is None and got[2].verdict == "block"
    assert got[1000].verdict == "allow" or got[1000].template.startswith("/")
    assert judged_urls(df.limit(0), rules).count() == 0


def test_the_rules_of_the_query_reject_unruled_pages(spark):
    """Judged by other hosts' pages of the same template; a host's own labels come first; names and
    numerals become wildcards; no depth is cut; similar branches merge and different ones do not."""
    rnd = random.Random(8)
    name = lambda: "".join(rnd.choice("abcdefgh") for _ in range(8))
    urls = []
    for i in range(60):
        urls += [f"http://h{i % 5}.example.org/es/{name()}", f"http://h{i % 5}.example.org/fr/{i}", f"http://h{i % 5}.example.org/it/{name()}"]
        urls += [f"http://new.net/es/{i}", f"http://new.net/fr/{name()}"]
    # Only the sixth segment tells good from bad.
    rules = [*URL_RULES, *[r._replace(host="deep.biz", path="/a/b/c/d/" + x, verdict=v) for r in URL_RULES[:1] for x, v in (("e/", "block"), ("f/", "allow"))]]
    for i in range(40):
        urls += [f"http://deep.biz/a/b/c/d/e/{i}", f"http://deep.biz/a/b/c/d/f/{i}", f"http://other.biz/a/b/c/d/e/{name()}", f"http://other.biz/a/b/c/d/f/{i}"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judged_urls(df, rules).collect()}
    by = lambda start: {got[i].verdict for i, u in enumerate(urls) if u.startswith(start)}
    assert {r.rule for r in got.values() if r.host in ("new.net", "other.biz")} == {None}
    assert by("http://new.net/es/") == {"block"} and by("http://new.net/fr/") == {"allow"}
    assert by("http://other.biz/a/b/c/d/e/") == {"block"} and by("http://other.biz/a/b/c/d/f/") == {"allow"}
    template = {u.split("/")[2] + "/" + u.split("/")[3]: got[i].template for i, u in enumerate(urls)}
    assert template["h1.example.org/es"].startswith("/es") and template["h1.example.org/fr"].startswith("/{fr|it}")
    assert template["new.net/es"] == "/es/*" and template["new.net/fr"] == "/fr/*"


def test_a_branch_that_differs_is_not_merged(spark):
    """Shares 0.1, 0.3 and 0.95 under one parent stay three."""
    rules = [r._replace(host="mix.biz", path=f"/{k}/{bad}", verdict=v) for r in URL_RULES[:1] for k in "abc" for bad, v in (("x", "block"), ("y", "allow"))]
    urls = [f"http://mix.biz/{k}/{'x' if i < share else 'y'}{i}" for k, share in (("a", 10), ("b", 30), ("c", 95)) for i in range(100)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    seen = {r.template.split("/")[1] for r in judged_urls(df, rules).collect()}
    assert seen == {"a", "b", "c"}
