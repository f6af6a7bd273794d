"""Near-duplicate documents by SimHash, with pivot distance tables.

A fingerprint has the bits that more than half of a text's hashed word shingles have. Documents of one fingerprint are one
row from the start. The Hamming distances of a fingerprint to PIVOTS reference fingerprints are computed once and packed
into words, seven to a word. Since |d(x, p) - d(y, p)| <= d(x, y), two fingerprints of which any coordinate differs by
more than the limit are not linked; a few additions test seven coordinates at once. What this leaves is verified by
counting differing bits.

Distances to references cannot be joined on equality by themselves (a reference is 32 +- 4 bits away from any unrelated
fingerprint, so one coordinate keeps almost half of all pairs), and all pairs must not be formed. So fingerprints first
meet in an equi-join: their bits are cut into BLOCKS blocks; a linked pair differs in at most `limit` bits, so in all but
`limit` of the blocks it agrees, and each choice of so many blocks is a key. The table discards inside that join,
and only verified links leave it: their number, not that of a crowd's pairs, is what is written. Skewed keys are
split by Spark. Links end in connected components.

Defined cases: a null or empty text, or one of white space, has fingerprint zero and is linked like any other; null ids
have a fingerprint, but a null component, and link nothing; repeated rows are alike, an id of several texts has a line
for each; texts of any length are read whole, in pieces; an empty table gives an empty result; of other columns than
doc_id and text none are read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, id_text_batches, materialise, small_batches
from tessera.llm.components import connected_components
from tessera.llm.shingles import U64, mix

SEED, BITS = 42, 64
#: Coordinates of a word of the table: a byte each, the top byte stays free.
LANES = 7
#: Shingles whose bits are counted at once.
PIECE = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Shingles of `k` words; fingerprints link at `limit` or fewer differing bits; `pivots` references, a multiple of LANES."""

    k: int = 3
    limit: int = 3
    pivots: int = 28
    blocks: int = 6

    def references(self) -> np.ndarray:
        """The reference fingerprints: fixed, spread evenly by a hash of their numbers."""
        return mix(np.arange(1, self.pivots + 1, dtype=U64) * U64(0xD6E8FEB86659FD93))


def shingle_hashes(words: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles, repeats included, in pieces."""
    if len(words) < k:
        words, k = ([b" ".join(words)] if words else []), 1
    for at in range(0, len(words) - k + 1, PIECE):
        some = words[at : at + PIECE + k - 1]
        joined = map(b" ".join, zip(*(some[i:] for i in range(k)), strict=False))
        yield np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), U64)


def fingerprint(text: str, k: int = 3) -> int:
    """The fingerprint of a text as an unsigned number."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text.encode("utf-8", "surrogatepass").lower().split(), k):  # A-Z alone; ASCII white space
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and fingerprint (64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in id_text_batches(batches):
            found = np.array([fingerprint(t, settings.k) for t in texts], U64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def pivot_table(fingerprint: Column, settings: Settings) -> list[Column]:
    """The distances to the references, a byte each, packed into longs."""
    distances = [F.bit_count(fingerprint.bitwiseXOR(F.lit(_signed(int(p))))).cast("long") for p in settings.references()]
    return [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(d, 8 * i) for i, d in enumerate(distances[at : at + LANES])]) for at in range(0, len(distances), LANES)]


def _each(byte: int) -> int:
    return sum(byte << 8 * i for i in range(LANES))


def within(a: Column, b: Column, limit: int) -> Column:
    """True if no coordinate of two packed words differs by more than `limit`: each lane keeps its high bit in both differences."""
    high = F.lit(_each(0x80))
    over = lambda x, y: x.bitwiseOR(high) + F.lit(_each(limit)) - y
    return over(a, b).bitwiseAND(over(b, a)).bitwiseAND(high) == high


def block_keys(fingerprint: Column, settings: Settings) -> Column:
    """A key for each choice of blocks in which a linked pair may agree: the choice and the blocks' bits."""
    cuts = [round(i * BITS / settings.blocks) for i in range(settings.blocks + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    block = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in zip(cuts, widths, strict=False)]
    keys = []
    for number, chosen in enumerate(combinations(range(settings.blocks), settings.blocks - settings.limit)):
        key = F.lit(number).cast("long")
        for i in chosen:
            key = F.shiftleft(key, widths[i]).bitwiseOR(block[i])
        keys.append(key)
    return F.array(*keys)


def links(distinct: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(u, v) of the linked pairs of distinct fingerprints, u < v."""
    tables = [f"t{i}" for i in range(settings.pivots // LANES)]
    told = distinct.select("fingerprint", *[c.alias(t) for c, t in zip(pivot_table(F.col("fingerprint"), settings), tables, strict=True)])
    keyed = told.select(F.explode(block_keys(F.col("fingerprint"), settings)).alias("key"), "*")
    a, b = (keyed.select(*[F.col(c).alias(f"{side}_{c}") for c in keyed.columns]) for side in "ab")
    near = F.col("a_fingerprint") < F.col("b_fingerprint")
    for t in tables:
        near &= within(F.col(f"a_{t}"), F.col(f"b_{t}"), settings.limit)
    near &= F.bit_count(F.col("a_fingerprint").bitwiseXOR(F.col("b_fingerprint"))) <= settings.limit
    met = a.hint("merge").join(b, (F.col("a_key") == F.col("b_key")) & near)
    return met.select(F.col("a_fingerprint").alias("u"), F.col("b_fingerprint").alias("v")).distinct()


def components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable by links, for every row."""
    if settings.pivots % LANES or settings.limit >= settings.blocks:
        raise ValueError("pivots fill words of seven, and there are more blocks than differing bits")
    prints = materialise(fingerprints(docs, settings), "fingerprints")
    distinct = materialise(prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "distinct")
    edges = materialise(links(distinct, settings), "links")
    found = connected_components(edges)
    discard(edges)
    linked = found.join(distinct, found.node == distinct.fingerprint).select("node", "component", "rep")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    moved = linked.join(least, "component").filter("least < rep").select(F.col("node").alias("fingerprint"), "least")
    placed = distinct.join(moved, "fingerprint", "left").select("fingerprint", F.coalesce("least", "rep").alias("component_id"))
    named = prints.join(placed, "fingerprint", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), component)
