"""License scan against brute force; toxicity on held-out rows."""

import re
from collections import Counter
from math import ceil

from tidepanel.llm import licenses, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_scan(text):
    lowered = (text or "").translate(UP)
    words, places = WORD.findall(lowered), []
    for phrase, label in licenses.PHRASES.items():
        sought = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(sought)] == sought]
    base, near = {x for _, x in places}, {}
    for line in lowered.split("\n"):
        block = set(WORD.findall(line))
        for label, ts in licenses.TEMPLATES.items():
            for t in ts:
                own = set(t.split())
                if len(own & block) >= ceil(licenses.THRESHOLD * len(own) - 1e-9):
                    near[label] = max(near.get(label, 0), len(own & block) / len(own))
    starts = [s for s, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(near))), max([float(bool(base)), *near.values()])


def test_scan_against_every_line_and_template(spark, docs, rows, empty):
    notices = ["Licensed under CC BY-NC 4.0.", "GNU GENERAL PUBLIC LICENSE\nmit\nLicense", "cc by cc by cc\nby", "license apache license mit license", "the mit license released", "cafécc byé cc by",
               "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the conditions are met:", "Licensed under the Apache License, version 2"]
    notices += [t.replace(" ", "-", 3) for ts in licenses.TEMPLATES.values() for t in ts] + [" ".join(t.split()[k:]) for ts in licenses.TEMPLATES.values() for t in ts for k in (1, 2, 3)]
    given = [(r[0], r[1]) for r in rows] + [(900 + i, t) for i, t in enumerate(notices)]
    found = licenses.license_scan(spark.createDataFrame(given, "doc_id bigint, text string")).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, *slow_scan(t)) for i, t in given)
    assert any("mit-notice" in r["labels"] for r in found)
    assert licenses.license_scan(empty).count() == 0
    assert licenses.license_scan(docs).count() == len(rows)


def test_toxicity_on_held_out_rows(spark, sf_dir, docs, rows, empty):
    source = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/documents.parquet")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/labels.parquet")
    scored = toxicity.toxicity(source, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in scored) / len(scored) > 0.95
    toxic = [r["predicted"] for r in scored if r["toxic"]]
    assert sum(toxic) / len(toxic) > 0.9
    model = toxicity.fit(source, labels)
    out = toxicity.with_score(docs, model, name="own").collect()
    assert len(out) == len(rows) and all(0 <= r["own"] <= 1 for r in out)
    assert len({r["own"] for r in out if not (r["text"] or "").strip()}) == 1
    dropped = toxicity.drop_toxic(docs, labels)
    assert dropped.columns == docs.columns
    assert toxicity.toxicity(empty, labels).count() == 0


def test_without_labels_nothing_is_rejected(spark, docs, rows):
    none = spark.createDataFrame([(1, None), (None, 1), (7, 3)], "doc_id bigint, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.5}
    assert {r["predicted"] for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.drop_toxic(docs, none).count() == len(rows)


def test_a_misspelling_shares_n_grams():
    texts = [f"the {w} thing over there is" for w in ("nice", "good", "fine", "plain", "idiot", "idiots", "idiotic", "idiot!")] * 8
    model = toxicity.train(texts, [0, 0, 0, 0, 1, 1, 1, 1] * 8, steps=80)
    score = toxicity._scorer(*model.gram_scores())
    assert score("the idiott thing") > 0.5 > score("the niice thing")


def test_stripping_a_word_takes_linear_time():
    import time

    word_grams = toxicity.word_grams

    began = time.perf_counter()
    assert word_grams("a" + "." * 2_000_000 + "b")[:1] and not word_grams("." * 2_000_000)
    assert time.perf_counter() - began < 20
    for word in ("--hello!!--", "$x$", "!a!", "''it's''", "@@", "!!", "x"):
        assert word_grams(word) == word_grams(re.sub(r"^[^\w$@*]+|[^\w$@*!]+$", "", word))


def test_repeated_ids_count_once_in_training(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    once, twice = toxicity.fit(docs, labels), toxicity.fit(docs.unionByName(docs), labels)
    assert (once.scores == twice.scores).all() and once.bias == twice.bias
