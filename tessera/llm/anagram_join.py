"""Edit-distance join of names with anagram keys.

The multiset of a name's letters (code points) does not change when two of them are exchanged. A deletion, insertion or
substitution takes at most one letter from either side's multiset, so two names of distance at most `most` share the
multiset that is left when at most `most` letters are deleted from each. Every distinct name emits a key for each such
multiset: the sum of its letters' hashes, so that deleting a letter subtracts its hash. Names meet on equal keys in an
equi-join, and only where what was deleted on the two sides has no letter in common, which of all the keys of a pair is
the one of its multisets' intersection: every candidate pair leaves the join once. Bit-parallel distance (optimal string
alignment) then verifies the letters' order.

Rows of one name are aggregated before anything is emitted, so a name that holds a third of the rows is one name. All
steps are partial aggregates and shuffle joins, whose skewed partitions Spark splits; nothing is broadcast or collected.

Defined cases: rows with a null or empty name, or a null id, take no part; repeated rows and ids count as often as they
occur; names may have any length (a name's keys grow with the square of its distinct letters, not of its length); empty
tables give an empty result; of other columns none are read, whatever their names."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations_with_replacement, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, small_batches
from tessera.llm.shingles import U64, mix

#: Bits of a code point (plus one) in the packed letters that a key lacks.
LETTER = 21
#: Rows of keys made at once, and sets of letters listed at once.
KEYS_AT_ONCE, PICKS_AT_ONCE = 200_000, 1 << 16
#: Pairs verified at once.
PAIRS_AT_ONCE = 20_000
WORD = 64


# ------------------------------------------------------------------ keys
def _listed(kinds: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (letters to delete, as numbers of the distinct letters; how often each number came before in its row)."""
    for size in range(most + 1):
        left = combinations_with_replacement(range(kinds), size)
        while block := list(islice(left, PICKS_AT_ONCE)):
            picks = np.array(block, np.int64).reshape(len(block), size)
            again = np.zeros_like(picks)
            for i in range(1, size):
                again[:, i] = np.where(picks[:, i] == picks[:, i - 1], again[:, i - 1] + 1, 0)
            yield picks, again


@lru_cache(maxsize=128)
def _few_listed(kinds: int, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return list(_listed(kinds, most))


def deletion_keys(names: list[str], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the name, key, packed deleted letters) of every multiset that a name becomes by at most `most` deletions."""
    by_kinds: dict[int, list[int]] = defaultdict(list)
    letters = [sorted(Counter(map(ord, name)).items()) for name in names]
    for i, found in enumerate(letters):
        by_kinds[len(found)].append(i)
    for kinds, places in by_kinds.items():
        for picks, again in _few_listed(kinds, most) if kinds <= WORD else _listed(kinds, most):
            step = max(1, KEYS_AT_ONCE // len(picks))
            for at in range(0, len(places), step):
                some = places[at : at + step]
                told = np.array([letters[i] for i in some], np.int64).reshape(len(some), kinds, 2)
                codes, counts = told[:, :, 0].astype(U64), told[:, :, 1]
                hashes = mix((codes + U64(1)) * U64(0x9E3779B97F4A7C15))
                whole = (hashes * counts.astype(U64)).sum(axis=1, dtype=U64)
                keys = whole[:, None] - hashes[:, picks].sum(axis=2, dtype=U64)
                shifts = U64(LETTER) * np.arange(picks.shape[1], dtype=U64)
                gone = ((codes[:, picks] + U64(1)) << shifts).sum(axis=2, dtype=U64)
                who, which = np.nonzero((counts[:, picks] > again).all(axis=2))
                yield np.array(some, np.int64)[who], keys[who, which], gone[who, which]


def _keyed(names: DataFrame, most: int) -> DataFrame:
    """(key, node, gone) of `names` (node, name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for place, key, gone in deletion_keys(batch.column("name").to_pylist(), most):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(nodes[place]), pa.array(gone.view(np.int64))], names=["key", "node", "gone"])

    return names.select("node", "name").mapInArrow(run, "key long, node long, gone long")


def _apart(a: Column, b: Column, most: int) -> Column:
    """True where two packed sets of letters have none in common."""
    mask = (1 << LETTER) - 1
    letter = lambda c, i: F.shiftrightunsigned(c, LETTER * i).bitwiseAND(F.lit(mask))
    out = F.lit(True)
    for i in range(most):
        for j in range(most):
            out &= (letter(a, i) == 0) | (letter(a, i) != letter(b, j))
    return out


# ------------------------------------------------------------------ distance
def distance(a: str, b: str) -> int:
    """Optimal string alignment of two texts of any length, one bit a letter of `a`."""
    if not a:
        return len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last, found = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down, diagonal, before = full, 0, 0, 0
    for c in b:
        here = masks.get(c, 0)
        crossed = ((~diagonal & here) << 1) & before
        diagonal = ((((here & up) + up) ^ up) | here | down | crossed) & full
        more, fewer = (down | ~(diagonal | up)) & full, diagonal & up
        found += bool(more & last) - bool(fewer & last)
        more, fewer = (more << 1 | 1) & full, (fewer << 1) & full
        up, down, before = (fewer | ~(diagonal | more)) & full, more & diagonal, here
    return found


def _codes(texts: list[str], blank: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), max(8, -(-int(sizes.max(initial=1)) // 8) * 8)), blank, np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return out, sizes


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """`distance` of many pairs at once: texts of up to a word side by side, longer ones one by one."""
    out = np.zeros(len(a), np.int64)
    short = np.array([0 < len(x) <= WORD for x in a], bool)
    for i in np.flatnonzero(~short):
        out[i] = distance(a[i], b[i])
    chosen = np.flatnonzero(short)
    if not len(chosen):
        return out
    pattern, m = _codes([a[i] for i in chosen], -1)
    text, n = _codes([b[i] for i in chosen], -2)
    last = U64(1) << (m - 1).astype(U64)
    found = m.copy()
    up, down, diagonal, before = np.full(len(chosen), ~U64(0)), *(np.zeros(len(chosen), U64) for _ in range(3))
    bits = np.zeros((len(chosen), 8), np.uint8)
    for t in range(int(n.max(initial=0))):
        bits[:, : pattern.shape[1] // 8] = np.packbits(pattern == text[:, t : t + 1], axis=1, bitorder="little")
        here = bits.view("<u8").reshape(-1).astype(U64)
        crossed = ((~diagonal & here) << U64(1)) & before
        diagonal = (((here & up) + up) ^ up) | here | down | crossed
        more, fewer = down | ~(diagonal | up), diagonal & up
        found += np.where(t < n, ((more & last) != 0).astype(np.int64) - ((fewer & last) != 0), 0)
        more, fewer = more << U64(1) | U64(1), fewer << U64(1)
        up, down, before = fewer | ~(diagonal | more), more & diagonal, here
    out[chosen] = found
    return out


def _verified(pairs: DataFrame, most: int) -> DataFrame:
    """`pairs` (left, left_name, right, right_name) of distance at most `most`: left, right, distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), PAIRS_AT_ONCE):
                part = batch.slice(at, PAIRS_AT_ONCE)
                apart = distances(part.column("left_name").to_pylist(), part.column("right_name").to_pylist())
                out = pa.RecordBatch.from_arrays([part.column("left"), part.column("right"), pa.array(apart, pa.int32())], names=["left", "right", "distance"])
                yield out.filter(pa.array(apart <= most))

    return pairs.mapInArrow(run, "left long, right long, distance int")


# ------------------------------------------------------------------ join
def named(rows: DataFrame, id_column: str, name: str, seed: int = 0) -> DataFrame:
    """The distinct names of `rows`: node (a hash of the name), name, n, first_id, ids_crc."""
    some = rows.select(F.col(id_column).cast("long").alias("id"), F.col(name).cast("string").alias("name")).filter("id is not null and name <> ''")
    crc = F.sum(F.crc32(F.col("id").cast("string").cast("binary")))
    return some.groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), crc.alias("ids_crc")).withColumn("node", F.xxhash64("name", F.lit(seed)))


def _distinct_nodes(names: DataFrame) -> bool:
    return not names.groupBy("node").count().filter("count > 1").take(1)


def matches(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """(left, right, distance), each pair once, of the nodes of `left` and `right` (node, name) whose names are at most `most` apart."""
    if not 0 <= most <= 3:
        raise ValueError("at most three edits: the letters that a key lacks are packed into 63 bits")
    small_batches(left.sparkSession)
    a, b = (_keyed(x, most).toDF("key", side, f"{side}_gone") for x, side in ((left, "left"), (right, "right")))
    # a name makes a hundred keys or more, which Spark's size of the names does not show: it would broadcast them as a small table
    met = a.join(b.withColumnRenamed("key", "right_key").hint("merge"), (F.col("key") == F.col("right_key")) & _apart(F.col("left_gone"), F.col("right_gone"), most)).select("left", "right")
    texts = lambda x, side: x.select(F.col("node").alias(side), F.col("name").alias(f"{side}_name"))
    pairs = met.join(texts(right, "right").hint("merge"), "right").join(texts(left, "left").hint("merge"), "left")
    return _verified(pairs.select("left", "left_name", "right", "right_name"), most).dropDuplicates(["left", "right"])


def join(left: DataFrame, left_id: str, left_name: str, right: DataFrame, right_id: str, right_name: str, most: int = 2) -> DataFrame:
    """(right_id, distance, n, first_id, ids_crc): for every row of `right` and distance with a match, how many rows of `left` match,
    the smallest id of theirs and the sum of their ids' crc32."""
    seed = 0
    while True:
        a = materialise(named(left, left_id, left_name, seed), "names")
        b = materialise(named(right, right_id, right_name, seed), "names")
        if _distinct_nodes(a) and _distinct_nodes(b):
            break
        seed += 1  # two names with one hash
    found = matches(a, b, most).join(a.select(F.col("node").alias("left"), "n", "first_id", "ids_crc").hint("merge"), "left")
    told = found.groupBy("right", "distance").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.sum("ids_crc").alias("ids_crc"))
    rows = right.select(F.col(right_id).cast("long").alias("right_id"), F.col(right_name).cast("string").alias("name")).filter("right_id is not null and name <> ''")
    return rows.select("right_id", F.xxhash64("name", F.lit(seed)).alias("right")).join(told.hint("merge"), "right").select("right_id", "distance", "n", "first_id", "ids_crc")


def misspelt(vendors: DataFrame) -> DataFrame:
    """vendor_id and name, where an even crc32 of the id exchanges two neighbouring letters of a name of two or more."""
    h, size, name = F.crc32(F.col("vendor_id").cast("string").cast("binary")), F.char_length("name"), F.col("name")
    at = (h % F.greatest(size - 1, F.lit(1))).cast("int")
    swapped = F.concat(F.substr(name, F.lit(1), at), F.substr(name, at + 2, F.lit(1)), F.substr(name, at + 1, F.lit(1)), F.substr(name, at + 3))
    return vendors.select("vendor_id", F.when((h % 2 == 0) & (size >= 2), swapped).otherwise(name).alias("name"))


def vendor_clients(clients: DataFrame, vendors: DataFrame, most: int = 2) -> DataFrame:
    """vendor_id, distance, n_clients, first_client_id, clients_crc: clients whose names are near a vendor's misspelt one.

    A vendor_id of several rows gets one line for each distance, over all of its rows."""
    found = join(clients, "client_id", "name", misspelt(vendors), "vendor_id", "name", most)
    return found.groupBy(F.col("right_id").alias("vendor_id"), "distance").agg(
        F.sum("n").alias("n_clients"), F.min("first_id").alias("first_client_id"), F.sum("ids_crc").alias("clients_crc")
    )


def sql_crc(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    byte = "list_reduce(range(8), lambda r, k: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, x))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda z: CAST(ord(z) AS BIGINT)), lambda c, x: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


#: Optimal string alignment as a table of two rows that letters of `a` push on, for every pair of similar length.
ORACLE_SQL = f"""
WITH c AS (SELECT client_id, name, {sql_crc('CAST(client_id AS VARCHAR)')} AS crc FROM clients WHERE name <> ''),
v0 AS (SELECT vendor_id, name, {sql_crc('CAST(vendor_id AS VARCHAR)')} AS h, length(name) AS n FROM vendors WHERE name <> ''),
v1 AS (SELECT vendor_id, name, h, n, CAST(CASE WHEN n > 1 THEN h % (n - 1) ELSE 0 END AS BIGINT) AS place FROM v0),
v AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN substr(name, 1, place) || substr(name, place + 2, 1) || substr(name, place + 1, 1) || substr(name, place + 3) ELSE name END AS name FROM v1),
pairs AS (SELECT vendor_id, client_id, crc, string_split(c.name, '') AS a, string_split(v.name, '') AS b
  FROM c JOIN v ON abs(length(c.name) - length(v.name)) <= 2),
told AS (SELECT vendor_id, client_id, crc, list_reduce(list_transform(range(1, len(a) + 1), lambda i: [[i]]),
  lambda acc, row: [acc[2], list_reduce(list_transform(range(1, len(b) + 1), lambda j: [j]),
    lambda done, col: list_append(done, least(done[len(done)] + 1, acc[2][col[1] + 1] + 1, acc[2][col[1]] + CASE WHEN a[row[1][1]] = b[col[1]] THEN 0 ELSE 1 END,
      CASE WHEN row[1][1] > 1 AND col[1] > 1 AND a[row[1][1]] = b[col[1] - 1] AND a[row[1][1] - 1] = b[col[1]] THEN acc[1][col[1] - 1] + 1 ELSE 1000000 END)), [row[1][1]])],
  [range(0, len(b) + 1), range(0, len(b) + 1)]) AS rows FROM pairs)
SELECT vendor_id, CAST(rows[2][len(rows[2])] AS INTEGER) AS distance, count(*) AS n_clients, min(client_id) AS first_client_id, CAST(sum(crc) AS BIGINT) AS clients_crc
FROM told WHERE rows[2][len(rows[2])] <= 2 GROUP BY ALL
"""
