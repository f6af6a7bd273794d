"""Merkle manifest of a dataset with parent-preimage paths.

H is the lowercase hexadecimal sha256 of its inputs, concatenated; digests go in as their 64 characters. A row's leaf is H
of its fields. In each tree (one for each language) leaves ascend, and every FAN consecutive nodes become their H until
one is left, the tree's subroot. The subroots, ordered by language, are the leaves of one more tree, whose top is the root.

Every parent stores its preimage: the digests of its children one after another. A leaf's path is the list of its
ancestors' preimages with the slot that its own line takes in each. Excising the slot's 64 characters leaves the siblings
(the proof); splicing a replacement into it and hashing gives the parent's new digest, so folding a path needs nothing
else. Paths are handed down from the root: each level joins the one above it, which is an eighth as long, and all rows
are joined once, with their parents.

Positions are counted without any window over a tree: rows are dealt out by ranges of (tree, order), numbered inside their
partition, and a partition's share of a tree is offset by those before it. Nothing but the number of levels reaches the
driver.

Defined cases: every row is a leaf, repeated rows too; rows of one tree with equal ids ascend by their leaves (nulls
first), so equal rows have equal leaves, but paths of their own; null fields enter as `-`, a null language is a tree of
its own; an empty text is `0:`; a tree of one leaf has that leaf as its subroot; an empty table gives an empty result
(and no root); columns that are not named are not read."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise

#: Children of a parent, and characters of a digest (fixed values).
FAN, DIGEST = 8, 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<preimage:string,slot:int>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _ranked(rows: DataFrame, tree: str, order: list[Column], what: str) -> DataFrame:
    """`rows`, written, with pos (from 0) in their tree and n, its rows; `tree` is never null."""
    keys = [F.col(tree), *order]
    row = F.monotonically_increasing_id()  # of a sorted partition, written at once: the partition and the row's number in it
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__row", row).withColumn("__part", F.shiftright("__row", 33))
    numbered = materialise(spread, "numbered")
    shares = numbered.groupBy(tree, "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__count"))
    before = W.partitionBy(tree).orderBy("__part")  # a row for each partition
    placed = shares.select(
        tree, "__part", "__first", F.sum("__count").over(before).alias("__until"), "__count", F.sum("__count").over(W.partitionBy(tree)).alias("n")
    ).withColumn("__shift", F.col("__until") - F.col("__count") - F.col("__first"))
    found = numbered.join(placed.select(tree, "__part", "__shift", "n"), [tree, "__part"]).withColumn("pos", F.col("__row") + F.col("__shift")).drop("__row", "__part", "__shift")
    out = materialise(found, what)
    discard(numbered)
    return out


def _grown(leaves: DataFrame) -> list[DataFrame]:
    """The levels above `leaves` (tree, pos, n, digest): tree, pos, n, preimage, digest; n counts the level's nodes of the tree."""
    levels, now = [], leaves.select("tree", "pos", "n", "digest")
    while now.filter("n > 1").take(1):
        children = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        parents = now.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / FAN).alias("pos")).agg(F.ceil(F.max("n") / FAN).alias("n"), F.array_join(F.transform(children, lambda x: x["digest"]), "").alias("preimage"))
        now = materialise(parents.withColumn("digest", F.sha2("preimage", 256)), "level")
        levels.append(now)
    return levels


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """tree and digest of each tree's last node."""
    out = leaves.filter("n = 1").select("tree", "digest")
    for level in levels:
        out = out.unionAll(level.filter("n = 1").select("tree", "digest"))
    return out


def _with_paths(leaves: DataFrame, levels: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """`leaves` with their path up to the top of their tree, and on along that of `above` (tree, path and what else a tree hands down to its leaves)."""
    handed = [] if above is None else [c for c in above.columns if c not in ("tree", "path")]
    parents: DataFrame | None = None
    for here in [*reversed(levels), leaves]:
        tops = here.filter("n = 1")
        out = tops.withColumn("path", F.array().cast(PATH)) if above is None else tops.join(above, "tree")
        if parents is not None:
            up = parents.select(F.col("tree").alias("__tree"), F.col("pos").alias("__pos"), F.col("preimage").alias("__preimage"), F.col("path").alias("__above"), *handed)
            # a merge join at every size: parents grow with the leaves
            lower = here.filter("n > 1").join(up.hint("merge"), (F.col("tree") == F.col("__tree")) & (F.floor(F.col("pos") / FAN) == F.col("__pos")))
            step = F.struct(F.col("__preimage").alias("preimage"), (F.col("pos") % FAN).cast("int").alias("slot"))
            out = out.unionByName(lower.withColumn("path", F.concat(F.array(step), "__above")).drop("__tree", "__pos", "__preimage", "__above"))
        parents = out
    return parents


@dataclass(frozen=True)
class Manifest:
    """`leaves`: the given columns with tree, pos, n, digest (and subroot); `levels` and `top_levels`: parents with their
    preimages, of the trees and of the tree over their subroots; `subroots`: tree, pos, n, digest."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    top_levels: list[DataFrame]

    def root(self) -> DataFrame:
        """One row with the root; none of an empty table."""
        return _tops(self.subroots, self.top_levels).select(F.col("digest").alias("root"))

    def paths(self) -> DataFrame:
        """The leaves with path, subroot and root; these two come down with the paths, so no row is joined by its tree."""
        told = self.root().select("root", F.lit(1).alias("__one"))
        tops = _with_paths(self.subroots, self.top_levels, None).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path", F.lit(1).alias("__one"))
        return _with_paths(self.leaves, self.levels, materialise(tops.join(told, "__one").drop("__one"), "tops"))

    def write(self, path: str) -> None:
        """The manifest as Parquet: leaves, parents (level from 1) and top_parents, and the root."""
        self.leaves.write.parquet(f"{path}/leaves")
        for name, levels in (("parents", self.levels), ("top_parents", self.top_levels)):
            for k, level in enumerate(levels, 1):
                level.withColumn("level", F.lit(k)).write.mode("append").parquet(f"{path}/{name}")
        self.subroots.write.parquet(f"{path}/subroots")
        self.root().write.parquet(f"{path}/root")


def read(spark: SparkSession, path: str) -> Manifest:
    """A manifest that was written."""
    parts = []
    for name in ("parents", "top_parents"):
        try:
            rows = spark.read.parquet(f"{path}/{name}")
        except Exception as error:  # a dataset of one row has no parents
            if "PATH_NOT_FOUND" not in str(error):
                raise
            parts.append([])
            continue
        last = rows.agg(F.max("level")).first()[0] or 0
        parts.append([rows.filter(F.col("level") == k).drop("level") for k in range(1, last + 1)])
    return Manifest(spark.read.parquet(f"{path}/leaves"), parts[0], spark.read.parquet(f"{path}/subroots"), parts[1])


def build(rows: DataFrame, tree: Column, order: list[str]) -> Manifest:
    """The manifest of `rows`, which have a digest column: trees by `tree` (its nulls are one), leaves ascending by the columns of `order`, then by digest."""
    name = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-"))  # - sorts before =
    leaves = _ranked(rows.withColumn("tree", name), "tree", [*map(F.col, order), F.col("digest")], "leaves")
    levels = _grown(leaves)
    named = _tops(leaves, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = _ranked(named, "tree", [F.col("name")], "subroots")
    return Manifest(leaves, levels, subroots, _grown(subroots))


def siblings(path: Column) -> Column:
    """The digests beside a path, level by level: each preimage without the slot."""
    return F.array_join(F.transform(path, lambda x: F.concat(F.substr(x["preimage"], F.lit(1), DIGEST * x["slot"]), F.substr(x["preimage"], DIGEST * x["slot"] + DIGEST + 1))), "")


def fold(path: Column, digest: Column) -> Column:
    """The root that a path gives with `digest` spliced into its slots."""
    spliced = lambda x, own: F.concat(F.substr(x["preimage"], F.lit(1), DIGEST * x["slot"]), own, F.substr(x["preimage"], DIGEST * x["slot"] + DIGEST + 1))
    return F.aggregate(path, digest, lambda own, x: F.sha2(spliced(x, own), 256))


def tampered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def verify(docs: DataFrame, tamper: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; rows that `tamper` picks are folded with the leaf of their lower-cased text."""
    own = leaf(*map(F.col, FIELDS))
    changed = leaf(*[tampered(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    held = docs.select("doc_id", "lang", own.alias("digest"), F.when(F.coalesce(tamper, F.lit(False)), changed).alias("changed"))
    manifest = build(held, F.col("lang"), ["doc_id"])
    found = manifest.paths()
    folded = fold(F.col("path"), F.coalesce("changed", "digest"))
    out = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_third(doc_id: str = "doc_id") -> Column:
    """True where 3 divides the crc32 of the decimal id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 0


_UP, _LOW = string.ascii_uppercase, string.ascii_lowercase
_FIELD = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x) for x in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


def oracle_sql(crc: str) -> str:
    """Trees grown level by level, proofs gathered by walking up with row numbers; `crc` is the crc32 of the decimal doc_id."""
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, lang, {_sql_leaf('text')} AS leaf, {_sql_leaf(f"translate(text, '{_UP}', '{_LOW}')")} AS other, {crc} % 3 = 0 AS hit FROM documents),
placed AS (SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM docs),
lv(level, tree, pos, n, digest) AS (SELECT 0, tree, pos, n, leaf FROM placed
  UNION ALL SELECT level + 1, tree, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM lv WHERE n > 1 GROUP BY level, tree, pos // 8, n),
tops AS (SELECT tree, level, digest AS subroot FROM lv WHERE n = 1),
tl(level, pos, n, digest) AS (SELECT 0, row_number() OVER (ORDER BY tree) - 1, count(*) OVER (), subroot FROM tops
  UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tl WHERE n > 1 GROUP BY level, pos // 8, n),
root AS (SELECT digest AS root FROM tl WHERE n = 1),
high AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS pos FROM tops),
nodes AS (SELECT level, tree, pos, digest, pos // 8 AS parent, n FROM lv UNION ALL SELECT 1000 + level, '', pos, digest, pos // 8, n FROM tl),
runs AS (SELECT level, tree, parent, list(digest ORDER BY pos) AS run FROM nodes WHERE n > 1 GROUP BY ALL),
walk(id, level, tree, pos, home, beside, now) AS (SELECT row_number() OVER (), 0, tree, pos, tree, '', CASE WHEN hit THEN other ELSE leaf END FROM placed
  UNION ALL SELECT id, CASE WHEN r.run IS NULL THEN 1000 ELSE w.level + 1 END, CASE WHEN r.run IS NULL THEN '' ELSE w.tree END, CASE WHEN r.run IS NULL THEN h.pos ELSE w.pos // 8 END, home,
    CASE WHEN r.run IS NULL THEN beside ELSE beside || array_to_string(r.run[:w.pos % 8] || r.run[w.pos % 8 + 2:], '') END,
    CASE WHEN r.run IS NULL THEN now ELSE sha256(array_to_string(r.run[:w.pos % 8] || [now] || r.run[w.pos % 8 + 2:], '')) END
  FROM walk w LEFT JOIN runs r ON r.level = w.level AND r.tree = w.tree AND r.parent = w.pos // 8 LEFT JOIN high h ON h.tree = w.home WHERE r.run IS NOT NULL OR w.level < 1000),
ends AS (SELECT id, arg_max(beside, level) AS beside, arg_max(now, level) AS now FROM walk GROUP BY id),
told AS (SELECT *, row_number() OVER () AS id FROM placed)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, now AS folded_root, now = root AS verified
FROM told JOIN ends USING (id) JOIN tops USING (tree) CROSS JOIN root
"""
