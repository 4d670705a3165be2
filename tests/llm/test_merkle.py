"""The Merkle manifest against a tree built in one piece, and what path copying shares."""

import hashlib
import random
import zlib

import pytest

from lakeshore.llm import merkle
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc, text, lang, source, n):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def _tree(nodes):
    """(root, siblings of every leaf as lists of (left, right))"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            run = nodes[k // 8 * 8:k // 8 * 8 + 8]
            paths[leaf].append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        at = [k // 8 for k in at]
        nodes = [_h("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def _want(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    out, roots, order = [], [], sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        roots.append(_tree([_leaf(*r) for r in groups[g]]))
    root, upper = _tree([r for r, _ in roots])
    for g, (subroot, paths), above in zip(order, roots, upper):
        for r, path in zip(groups[g], paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            text = "".join(c.lower() if c.isascii() else c for c in r[1]) if hit else r[1]
            fold = _leaf(r[0], text, *r[2:])
            for left, right in path + above:
                fold = _h(left + fold + right)
            proof = _h("".join(a + b for a, b in path + above))
            out.append((r[0], _leaf(*r), subroot, root, proof, fold, fold == root))
    return out


def _run(spark, tmp, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
    out = merkle.op13_merkle(spark, str(tmp))
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def _rows(n, langs, seed=1):
    rng = random.Random(seed)
    return [(k, rng.choice(["Ab cé", "low", "ÀB", None, ""]), rng.choice(langs), rng.choice(["s", None]), rng.choice([3, None]))
            for k in rng.sample(range(10 * n + 1), n)]


@pytest.mark.parametrize("n,langs", [(1, ["a"]), (2, ["a"]), (8, ["a"]), (9, ["a", None]), (65, ["z", "é", None]), (700, ["en", "de", "Z"]),
                                     (300, [f"l{k}" for k in range(40)])])
def test_equals_one_tree(spark, tmp_path, n, langs):
    rows = _rows(n, langs, n)
    assert _run(spark, tmp_path, rows) == sorted(_want(rows), key=repr)


def test_small_blocks(spark, tmp_path):
    rows = _rows(1500, ["en", "de", None], 4) + [(10**6 + k, "X", f"l{k:05}", None, None) for k in range(70)]
    whole = sorted(_run(spark, tmp_path, rows), key=repr)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for levels in (1, 2):  # of three and two tables of blocks in each group, and more above
        got = merkle.manifest(docs, merkle.tampered(docs), levels=levels)
        assert sorted(map(tuple, got.collect()), key=repr) == whole


def test_several_levels_of_blocks(spark, tmp_path):
    rows = _rows(5000, ["en"], 3) + [(10**6 + k, "X", f"l{k:05}", None, None) for k in range(20)]
    got = _run(spark, tmp_path, rows)
    assert got == sorted(_want(rows), key=repr)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(map(tuple, merkle.op13_merkle(spark, SF_SMALL).collect()), key=repr)
    assert got == sorted(_want(rows), key=repr)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_odd_tables(spark, tmp_path):
    assert _run(spark, tmp_path, []) == []
    rows = [(None, "A", "x", None, None), (3, "Same", None, "s", 1), (3, "Same", None, "s", 1), (3, "Other", None, "s", 1),
            (4, "Word " * 200_000, "x", "", 0), (5, "", "", None, None), (6, None, "y", None, None)]
    got = _run(spark, tmp_path, [(*r, "e", 1, "q") for r in rows], SCHEMA + ", rank string, place int, digest string")
    assert got == sorted(_want(rows), key=repr)
    same = [(9, "Equal rows", "x", "s", 1)] * 300
    assert _run(spark, tmp_path, same) == sorted(_want(same), key=repr)


def test_versions_share_untouched_nodes():
    rng = random.Random(2)
    for n, levels in [(1, None), (9, None), (100, None), (513, 4), (5, 4)]:
        leaves = [_h(str(k)) for k in range(n)]
        tree = merkle.PersistentTree(leaves, levels)
        before, height = list(tree.nodes), len(tree.levels) - 1
        assert levels in (None, height)
        for place in rng.sample(range(n), min(n, 20)):
            size = len(tree.nodes)
            version = tree.replaced(place, _h("new"))
            assert len(tree.nodes) == size + height + 1                  # the leaf and its ancestors
            other = merkle.PersistentTree(leaves[:place] + [_h("new")] + leaves[place + 1:], levels)
            assert tree.digest(version) == other.digest(other.root)
            assert merkle.folded(_h("new"), tree.paths("")[place]) == tree.digest(version)
        assert tree.nodes[:len(before)] == before                        # older versions are as they were
