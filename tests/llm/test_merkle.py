import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import KINDS
from tidepanel.llm.merkle import FIELDS, every_fifth_by_crc, manifest_digests, merkle_manifest


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def slow_manifest(rows, fan):
    """Trees of lists; rows are (doc_id, source, lang, n_chars, text)."""
    leaves, groups, steps, subroot = [leaf(r) for r in rows], {}, [[] for _ in rows], {}

    def climb(nodes):
        while len(nodes) > 1:
            up = []
            for at in range(0, len(nodes), fan):
                run = nodes[at : at + fan]
                for j, (_, members) in enumerate(run):
                    for m in members:
                        steps[m].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
                up.append((H("".join(d for d, _ in run)), [m for _, members in run for m in members]))
            nodes = up
        return nodes[0]

    for k, r in enumerate(rows):
        groups.setdefault(r[1], []).append(k)
    tops = []
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        order = sorted(groups[g], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))
        tops.append(climb([(leaves[k], [k]) for k in order]))
        subroot |= {k: tops[-1][0] for k in order}
    root = climb(tops)[0] if tops else None
    for k, r in enumerate(rows):
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        folded = leaf([*r[:4], lowered(r[4])]) if tampered else leaves[k]
        for before, after in steps[k]:
            folded = H(before + folded + after)
        yield r[0], leaves[k], subroot[k], root, H("".join(b + a for b, a in steps[k])), folded, folded == root


@pytest.mark.parametrize("fan", [2, 16])
def test_manifest(spark, docs, fan):
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    got = manifest_digests(merkle_manifest(docs, tampered=every_fifth_by_crc(), fan=fan)).collect()
    assert Counter(map(tuple, got)) == Counter(slow_manifest(rows, fan))


def test_deep_group_many_sources_and_nulls(spark):
    """A source with 3,000 of 3,400 rows, sources of one row, a null source, non-ASCII names, null ids."""
    kinds = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(3000)] + [(5000 + i, f"s{i % 300}" if i % 7 else None, None, None, None) for i in range(398)]
    rows += [(None, "é", "en", 1, "A"), (9000, "z", "en", 1, "Ä")]
    got = manifest_digests(merkle_manifest(spark.createDataFrame(rows, kinds).repartition(5), tampered=every_fifth_by_crc())).collect()
    assert Counter(map(tuple, got)) == Counter(slow_manifest(rows, 16))
    assert {True, False} == {r.verified for r in got}


def test_empty_and_a_lone_row(spark):
    assert merkle_manifest(spark.createDataFrame([], KINDS)).count() == 0
    one = spark.createDataFrame([(7, "Abc", "en", "s", 3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    (row,) = manifest_digests(merkle_manifest(one)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf((7, "s", "en", 3, "Abc"))
    assert row.proof_sha256 == H("") and row.verified
    (row,) = manifest_digests(merkle_manifest(one, tampered=F.lit(True))).collect()
    assert not row.verified


def test_columns_named_like_the_own_ones(spark, docs):
    odd = docs.select(*FIELDS, F.lit("x").alias("grp"), F.lit("y").alias("idx"), F.lit("z").alias("leaf"), F.lit(1).alias("digest"), F.lit(2).alias("_w"))
    same = lambda d: Counter(map(tuple, manifest_digests(merkle_manifest(d)).collect()))
    assert same(odd) == same(docs)
