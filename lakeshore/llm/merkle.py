"""Merkle manifest of a dataset with proofs per row, and versions of the tree by path copying.

A row's leaf is the SHA-256 (lowercase hex) of its fields, each ``-`` if null, else its UTF-8 byte count,
``:`` and value. Leaves of one group (``lang``) ascend by ``doc_id``; every ``ARITY`` consecutive nodes (the last run may be
shorter) become the hash of their digests until one is left, the subroot; subroots, ordered by group,
become the root in the same way.

Trees are cut into aligned blocks of 8^4 = 4,096 nodes. Going up, a task builds the tree of one block at a time
and hands on its top; the tops are the next level's nodes, so there are log(rows) / log(4,096) levels, each a shuffle of
a 4096th of the one below. Going down, each block gets the siblings on its top's way to the root, a few hundred
bytes per level. Texts are hashed where they are read and never move.

Inside a block the tree is persistent: nodes are never changed, and replacing a leaf adds its ancestors
alone, a copy each with one child exchanged, that share every other node. Each leaf starts such a version (from its
tampered digest if it has one); at the block's top the version goes on through the blocks above with the siblings that
came down, which gives the root that a reader holding the original proof would compute.

Defined results: a null group is a group and the first; null ids come first, rows with one id go by their leaf;
equal rows are leaves each; an empty table gives an empty result; a table of one row has root, subroot and leaf alike
and the hash of nothing as its proof. A null id is not tampered with. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc32_mod, join_same, sorted_copy, table

ARITY = 8
#: Levels of a block's tree, so a block has 8^4 leaves.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class PersistentTree:
    """The tree over one block's nodes; ``replaced`` gives versions that share all untouched nodes.

    A block of a larger tree reaches that many ``levels`` even if a run has one node; others (None) stop at
    one node.
    """

    def __init__(self, leaves: list[str], levels: int | None = None):
        self.nodes: list[tuple[str, tuple[int, ...]]] = []   # (digest, children), only ever appended to
        now = [self._add(d, ()) for d in leaves]
        self.levels = [now]
        while len(now) > 1 if levels is None else len(self.levels) <= levels:
            now = [self._join(tuple(now[k:k + ARITY])) for k in range(0, len(now), ARITY)]
            self.levels.append(now)

    def _add(self, digest: str, children: tuple[int, ...]) -> int:
        self.nodes.append((digest, children))
        return len(self.nodes) - 1

    def _join(self, children: tuple[int, ...]) -> int:
        return self._add(_hash("".join(self.nodes[c][0] for c in children)), children)

    @property
    def root(self) -> int:
        return self.levels[-1][0]

    def digest(self, node: int) -> str:
        return self.nodes[node][0]

    def replaced(self, place: int, digest: str) -> int:
        """The root of a version whose leaf at ``place`` has that digest: ancestors are copied, no more."""
        new = self._add(digest, ())
        for level in self.levels[1:]:
            place, k = divmod(place, ARITY)
            children = self.nodes[level[place]][1]
            new = self._join((*children[:k], new, *children[k + 1:]))
        return new

    def siblings(self, level: int, place: int) -> tuple[str, str]:
        """The other digests of a node's run: those before it and those after it."""
        run = self.levels[level][place // ARITY * ARITY:][:ARITY]
        k = place % ARITY
        return "".join(map(self.digest, run[:k])), "".join(map(self.digest, run[k + 1:]))

    def paths(self, above: str) -> list[str]:
        """Per leaf its siblings up to the root of the block and then ``above``: ``left,right;`` a level."""
        out = [above]
        for level in range(len(self.levels) - 2, -1, -1):
            out = [f"{left},{right};{out[place // ARITY]}"
                   for place in range(len(self.levels[level])) for left, right in [self.siblings(level, place)]]
        return out


def folded(digest: str, path: str) -> str:
    """The top that a node's digest and its path lead to."""
    for step in path.split(";")[:-1]:
        left, right = step.split(",")
        digest = _hash(left + digest + right)
    return digest


def proof_text(path: str) -> str:
    return path.replace(",", "").replace(";", "")


# --- on tables --------------------------------------------------------------------------------

def leaf(fields: tuple[Column, ...]) -> Column:
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(s.isNull(), F.lit("-"))
                             .otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)) for s in shown)), 256)


def _tree(nodes: pd.DataFrame, levels: int) -> PersistentTree:
    """A block's tree; ``n`` nodes on its level tell whether there are other blocks beside it."""
    return PersistentTree(nodes["digest"].tolist(), levels if nodes["n"].iat[0] > ARITY ** levels else None)


def _climb(nodes: DataFrame, group: str, levels: int, name: str) -> list[DataFrame]:
    """Tables ``group, n, block, place, digest, ..`` per level, the lowest first, and at last ``group, top``.

    ``n`` is how many nodes the group has on the level, ``block`` is which block a node is in. The last
    level is the first on which every group has one block.
    """
    tables, kind, block = [], nodes.schema[group].dataType.simpleString(), ARITY ** levels

    def top(nodes: pd.DataFrame) -> pd.DataFrame:
        tree = _tree(nodes.sort_values("place"), levels)
        return nodes.iloc[:1][[group, "n", "block"]].assign(top=tree.digest(tree.root))

    while True:
        nodes = materialize(nodes.withColumn("block", F.floor(F.col("place") / block)), f"{name}_{len(tables)}")
        tables.append(nodes)
        tops = (nodes.select(group, "n", "block", "place", "digest").groupBy(group, "n", "block")  # at most a block
                .applyInPandas(top, f"{group} {kind}, n long, block long, top string"))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= block:
            return [*tables, tops.select(group, "top")]
        nodes = tops.select(group, F.ceil(F.col("n") / block).alias("n"), F.col("block").alias("place"), F.col("top").alias("digest"))


def _block_paths(level: DataFrame, above: DataFrame, found, schema: str) -> DataFrame:
    """``found(nodes, path above the block)`` for every block; ``above`` has ``grp, block, path``."""
    def one(nodes: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
        return found(nodes.sort_values("place"), way["path"].iat[0])
    return level.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInPandas(one, schema)


def _node_paths(level: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """``grp, place, path`` of a level's nodes."""
    def paths(nodes: pd.DataFrame, above: str) -> pd.DataFrame:
        return nodes[["grp", "place"]].assign(path=_tree(nodes, levels).paths(above))
    kind = level.schema["grp"].dataType.simpleString()
    return _block_paths(level, above, paths, f"grp {kind}, place long, path string")


def _proofs(level: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """``grp, doc_id, leaf, proof_sha256, folded_root`` of the leaves, a version of the tree for each."""
    def proofs(nodes: pd.DataFrame, above: str) -> pd.DataFrame:
        leaves, hashes, folds = nodes["digest"].tolist(), [], []
        tree = _tree(nodes, levels)
        for place, (other, path) in enumerate(zip(nodes["tampered"], tree.paths(""))):
            version = tree.replaced(place, leaves[place] if other is None else other)
            hashes.append(_hash(proof_text(path + above)))
            folds.append(folded(tree.digest(version), above))
        return nodes[["grp", "doc_id"]].assign(leaf=leaves, proof_sha256=hashes, folded_root=folds)
    return _block_paths(level, above, proofs, "grp string, doc_id string, leaf string, proof_sha256 string, folded_root string")


def _descend(tables: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """``grp, block, path`` for the blocks of the lowest table, from the paths of the groups' tops."""
    paths = tops.select("grp", F.lit(0).cast("long").alias("block"), "path")
    for table_above in reversed(tables[1:]):
        paths = _node_paths(table_above, paths, levels).withColumnRenamed("place", "block")
    return paths


def manifest(docs: DataFrame, tampered_text: Column | None = None, group: str = "lang",
             levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``tampered_text``: where not null, the text with which the row's version is made. ``levels``: of a block.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    changed = F.lit(None).cast("string") if tampered_text is None else tampered_text
    own = leaf(tuple(changed if c == "text" else F.col(c) for c in FIELDS))
    leaves = docs.select(F.col(group).cast("string").alias("grp"), F.col("doc_id"), leaf(tuple(map(F.col, FIELDS))).alias("digest"),
                         F.when(changed.isNotNull(), own).alias("tampered"))
    ranked = sorted_copy(leaves, [F.col("grp"), F.col("doc_id"), F.col("digest")], "merkle_leaves")
    sizes = materialize(ranked.groupBy("grp").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "merkle_groups")
    # ids cross to Python as text: pandas turns integers with nulls among them into floats
    *tables, subroots = _climb(join_same(ranked, sizes, ["grp"]).select(
        "grp", "n", (F.col("rank") - F.col("first")).alias("place"), "digest", F.col("doc_id").cast("string").alias("doc_id"),
        "tampered"), "grp", levels, "merkle_level")
    # above: one tree whose leaves are the subroots in the order of their groups
    order = sorted_copy(subroots, [F.col("grp")], "merkle_subroots")
    total = order.count()
    *upper, top = _climb(order.select(F.lit(0).alias("grp"), F.lit(total).cast("long").alias("n"), F.col("rank").alias("place"),
                                      F.col("top").alias("digest")), "grp", levels, "merkle_upper")
    top = materialize(top, "merkle_root")
    ways = _node_paths(upper[0], _descend(upper, top.withColumn("path", F.lit("")), levels), levels)
    root = top.first()["top"] if total else None  # one digest
    tops = (order.join(ways.select(F.col("place").alias("rank"), "path"), "rank")
            .select("grp", F.col("top").alias("subroot"), F.lit(root).alias("root"), "path"))
    tops = materialize(tops, "merkle_tops")
    proved = _proofs(tables[0], _descend(tables, tops, levels), levels)
    return join_same(proved, tops.select("grp", "subroot", "root"), ["grp"]).select(
        F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered(docs: DataFrame) -> Column:
    """The query's tampered texts: A-Z in lower case where 3 divides the id's crc32, else null."""
    hit = docs["doc_id"].isNotNull() & (crc32_mod(docs["doc_id"], 3) == 0)
    return F.when(hit, F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, tampered(docs))


QUERIES = {"op13_merkle": op13_merkle}

_FIELD = "case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || cast({c} as varchar) end"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c=c) for c in FIELDS[:-1]) + ", {text}))"
# crc32 by its byte table, itself made from the reversed polynomial; the tree and the folds by recursion over levels
ORACLES = {"op13_merkle": f"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
docs as (
  select doc_id, lang, {_LEAF.format(text=_FIELD.format(c='text'))} as leaf,
         {_LEAF.format(text=_FIELD.format(c="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))} as lowered,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ascii(d) as bigint))),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as crc
  from documents, crc_table),
leaves as (
  select *, row_number() over () as id, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by lang) as n from docs),
nodes(lang, lvl, pos, h, n) as (
  select lang, 0, pos, leaf, n from leaves
  union all
  select lang, lvl + 1, pos // 8, sha256(string_agg(h, '' order by pos)), (n + 7) // 8 from nodes where n > 1
  group by lang, lvl, pos // 8, n),
subroots as (
  select lang, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
upper_nodes(lvl, pos, h, n) as (
  select 0, pos, h, n from subroots
  union all
  select lvl + 1, pos // 8, sha256(string_agg(h, '' order by pos)), (n + 7) // 8 from upper_nodes where n > 1 group by lvl, pos // 8, n),
steps as (
  select d.id, 0 as phase, x.lvl, coalesce(string_agg(x.h, '' order by x.pos) filter (x.pos < d.pos >> (3 * x.lvl)), '') as l,
         coalesce(string_agg(x.h, '' order by x.pos) filter (x.pos > d.pos >> (3 * x.lvl)), '') as r
  from leaves d join nodes x on x.lang is not distinct from d.lang and x.n > 1 and x.pos >> 3 = d.pos >> (3 * x.lvl + 3)
  group by d.id, x.lvl
  union all
  select d.id, 1, x.lvl, coalesce(string_agg(x.h, '' order by x.pos) filter (x.pos < s.pos >> (3 * x.lvl)), ''),
         coalesce(string_agg(x.h, '' order by x.pos) filter (x.pos > s.pos >> (3 * x.lvl)), '')
  from leaves d join subroots s on s.lang is not distinct from d.lang
    join upper_nodes x on x.n > 1 and x.pos >> 3 = s.pos >> (3 * x.lvl + 3)
  group by d.id, x.lvl),
numbered as (select *, row_number() over (partition by id order by phase, lvl) as k from steps),
folds(id, k, h) as (
  select id, cast(1 as bigint), case when crc % 3 = 0 then lowered else leaf end from leaves
  union all
  select f.id, f.k + 1, sha256(s.l || f.h || s.r) from folds f join numbered s on s.id = f.id and s.k = f.k),
proofs as (select id, sha256(string_agg(l || r, '' order by k)) as proof_sha256, max(k) + 1 as k from numbered group by id),
root as (select h as root from upper_nodes where n = 1)
select d.doc_id, d.leaf, s.h as subroot, root.root, coalesce(p.proof_sha256, sha256('')) as proof_sha256, f.h as folded_root, f.h = root.root as verified
from leaves d join subroots s on s.lang is not distinct from d.lang cross join root left join proofs p on p.id = d.id
  join folds f on f.id = d.id and f.k = coalesce(p.k, 1)"""}
