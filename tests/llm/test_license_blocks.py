"""License notices that are wrapped, and scattered words, against every window of words."""

import random
import textwrap
from math import ceil

from tests.llm.test_licenses_toxicity import UP, WORD
from tidepanel.llm import licenses


def slow_labels(text):
    words, width = WORD.findall((text or "").translate(UP)), 2 * max(len(t.split()) for ts in licenses.TEMPLATES.values() for t in ts)
    blocks = [set(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    near = {label for label, ts in licenses.TEMPLATES.items() for t in ts for b in blocks if len(set(t.split()) & b) >= ceil(licenses.THRESHOLD * len(set(t.split())) - 1e-9)}
    return ",".join(sorted(near | {label for phrase, label in licenses.PHRASES.items() if any(words[i : i + len(phrase.split())] == phrase.split() for i in range(len(words)))}))


def test_blocks_cross_lines_and_end(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    templates = [(label, t) for label, ts in licenses.TEMPLATES.items() for t in ts]
    texts = [f"{filler(70)}\n{textwrap.fill(t, width)}\n{filler(70)}" for _, t in templates for width in (20, 40, 72)]
    scattered = [" ".join(w + " " + filler(30) for w in t.split()) for _, t in templates]
    mixed = [" ".join(rng.choices(templates[-1][1].split() + templates[4][1].split() + ["w1"] * 9, k=rng.randrange(1, 200))) for _ in range(60)]
    given = list(enumerate(texts + scattered + mixed))
    found = {r["doc_id"]: r["labels"] for r in licenses.license_scan(spark.createDataFrame(given, "doc_id bigint, text string")).collect()}
    assert found == {i: slow_labels(t) for i, t in given}
    assert all(label in found[3 * k + i].split(",") for k, (label, _) in enumerate(templates) for i in range(3))
    assert not any(found[len(texts) + k] for k in range(len(templates)))
