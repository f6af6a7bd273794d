"""N-gram Jaccard self-join with parity sketches.

A shingle toggles one bit of its document's sketch, so the sketch holds parities and the Hamming distance of two sketches
never exceeds the symmetric difference of the two sets. Jaccard similarity of at least p % bounds that difference by
D = (100 - p) / (100 + p) of the summed sizes, and a partner's size by 100 / p of a document's own. For every band of sizes the sketch is cut into parts, each of 2**64 bits
of which almost all are zero: a part is kept as the xor of its toggled positions, hashed to a key. D differences spoil at
most D parts, so two linked documents share all but D of their parts that hold anything. Of these a document gives the
first D + 1 + s in one order for all documents (parts of most shingles first, as they tell most): by the argument of
prefix filters two linked documents then share at least 1 + s keys, and empty parts are never keys. Keys are packed
into buckets that one task groups at a time, and only keys of two documents or more go on.

So a document of which fewer than 1 + s keys are another document's too has no partner, and its keys go (a passage shared
with a few documents makes fewer). A key of more than FREQUENT documents (a common passage) is left out by every document that has at most s such keys: with
1 + s shared keys it still meets all its partners under another one. Those with more are heavy, and meet one another in
the finest cut of the sketch, where every shingle is a part and a key: linked documents share p % of these, so a document
leaves frequent ones out if they are fewer than p % of its shingles. Only documents of mostly frequent shingles (a crowd
of near copies) are left; they keep the frequent keys of the first cut. No pair is lost in any of the three cases. What a
task sees more often than FREQUENT is dealt by document, not by key, so no bucket grows with one key.

Nothing emits all pairs of a group: documents with equal sets are one node; the members of a join key are compared with
one hub only, the member of most keys (the least edited of a crowd of near copies), by their sketches. Those within one
and a half times the largest difference D of a linked pair are settled, and those within two and a half D are of the hub's
family. By the triangle inequality of Hamming distance a linked partner of a settled member is in the family, so what is
beyond the first bound meets again only if not all of it is in one family: under its first four members, then sixteen, and
so on. No link leaves the families that these pairs connect. Families are compared inside, in
chunks of bounded size: each chunk on its own together with the family's first members, then what is still outside the
family's largest component with every chunk. A chunk skips pairs that its own links already connect and returns only
links that join components.

Defined cases: documents without words have empty sets and are linked with nothing; rows with a null doc_id are not
linked (component null); repeated rows and equal texts are one node; an empty table gives an empty result; other columns
are not read. A set is hashed to 64 bits, with a second hash to detect two sets of one hash: then all is hashed anew."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import behind_plain_names, bloom_joins, discard, free_shuffles, id_text_batches, materialise
from tessera.llm.components import connected_components
from tessera.llm.shingles import U64, mix, shingle_sets

#: Documents of a key that is looked up by everyone; see above.
FREQUENT = 16
#: Keys that a task holds before it passes them on, and keys that a bucket is planned for.
HELD_KEYS, BUCKET_KEYS = 250_000, 500_000
LEAST_BUCKETS = 2048
#: A bucket's record: 38 bits of the key, the parity of its band, whether the document is thin; then the document's node.
RECORD = np.dtype([("low", "<u4"), ("high", "u1"), ("node", "<i8")])
#: Bits of the sketch that compares candidates: at least so many, and at least four a shingle.
FILTER_BITS = 2048
#: Members of a family that are compared in one task, and first members (a few by hash) that every chunk of a family gets.
CHUNK, FIRST = 768, 4
#: Shingles of such members, at most but for the last document's; sets of a task are held at once.
CHUNK_SHINGLES = 1_500_000


@dataclass(frozen=True)
class Measure:
    """Shingles of `k` words; two documents link if 100 * intersection >= percent * union."""

    k: int = 5
    percent: int = 80
    seed: int = 0

    def most_apart(self, summed_sizes):
        """The largest symmetric difference of a linked pair."""
        return summed_sizes * (100 - self.percent) // (100 + self.percent)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both > 0 and 100 * both >= self.percent * (len(a) + len(b) - both)

    @cached_property
    def bands(self) -> np.ndarray:
        """Smallest sizes of the bands: two linked documents lie in one band or in neighbouring ones."""
        bounds = [1]
        while bounds[-1] < 2**40:
            bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * max(160, -(-10_000 // self.percent)) // 100)))
        return np.array(bounds, np.int64)

    def own_band(self, sizes):
        return np.searchsorted(self.bands, sizes, side="right") - 1

    def difference(self, band):
        """D: the largest symmetric difference of a linked pair that meets in this band."""
        return self.most_apart(2 * (self.bands[np.asarray(band) + 1] - 1))

    def own_difference(self, size: int) -> int:
        """D of a document: from any partner, whose size its own bounds."""
        return int(self.most_apart(size + size * 100 // self.percent))

    def spare(self, band):
        """s: keys beyond D + 1 that a document gives in this band."""
        return 2 + (self.difference(band) + 1) // 8

    def partner_difference(self, sizes):
        """D of each size: the largest symmetric difference of a linked pair of which one has it."""
        return self.most_apart(sizes + sizes * 100 // self.percent)

    def settled(self, sizes, apart):
        """Whether all links of a set that is `apart` from a hub lie in the hub's family: it is near, at most twice D away."""
        return apart <= 2 * self.partner_difference(sizes)

    def in_family(self, sizes, apart):
        """Whether a set belongs to a hub's family: a settled partner is at most 100 / percent of its size, so its own D and twice that
        are three times the D of such a partner."""
        return apart <= 3 * self.partner_difference(sizes * 100 // self.percent + 1)


def parity_words(hashes: np.ndarray, words: int) -> np.ndarray:
    """The sketch of sorted hashes as `words` 64-bit words: the high bits choose the word, the low bits the bit."""
    word = ((hashes >> U64(32)) * U64(words)) >> U64(32)
    bits = U64(1) << (hashes & U64(63))
    out = np.zeros(words, U64)
    if len(hashes):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[first].astype(np.int64)] = np.bitwise_xor.reduceat(bits, first)
    return out


def join_keys(hashes: np.ndarray, measure: Measure) -> list[tuple[int, np.ndarray, bool]]:
    """(band, keys, thin) of one document for its own size band, and for the next one if a partner may lie there. A thin
    document has fewer parts that hold anything than D + 1 + s; with D or fewer it gives the key of all such documents."""
    own = int(measure.own_band(len(hashes)))
    out = []
    for band in (own, own + 1) if len(hashes) * 100 // measure.percent >= measure.bands[own + 1] else (own,):
        if not (most := measure.own_difference(len(hashes))):
            continue  # only equal sets link
        parts = max(64, 7 * (int(measure.difference(band)) + 1) // 5)
        part = ((hashes >> U64(32)) * U64(parts)) >> U64(32)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        count = np.diff(np.append(first, len(part)))
        keys = mix(np.bitwise_xor.reduceat(mix(hashes), first) ^ mix(part[first] + U64(band << 40)))
        take = most + 1 + int(measure.spare(band))
        thin = len(keys) < take
        if not thin:
            keys = keys[np.lexsort((keys, -count))[:take]]
        elif len(keys) <= most:
            keys = np.append(keys, mix(np.array([(band << 40) + (1 << 39)], U64)))
        out.append((band, keys, thin))
    return out


def filter_sketch(hashes: np.ndarray) -> bytes:
    bits = max(FILTER_BITS, 1 << (4 * len(hashes)).bit_length())
    return parity_words(hashes, bits // 64).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Of sketches of different lengths: the longer one is folded, words that shrink to one being xor-ed."""
    x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(len(y), -1), axis=1)
    return int(np.bitwise_count(x ^ y).sum())


def _set_hashes(hashes: np.ndarray, seed: int) -> tuple[int, int]:
    """Two hashes of a whole set: its node, and the check of it."""
    data = hashes.tobytes()
    return _signed(xxhash.xxh3_64_intdigest(data, seed)), _signed(xxhash.xxh64_intdigest(data, seed))


def _set_rows(docs: DataFrame, measure: Measure) -> DataFrame:
    """doc_id, n_shingles, node, check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in id_text_batches(batches):
            out = [(len(hashes), *_set_hashes(hashes, measure.seed)) for hashes in shingle_sets(texts, measure.k, measure.seed)]
            n, node, check = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, node, check))], names=["doc_id", "n_shingles", "node", "check"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long, check long")


def _with_texts(docs: DataFrame, asked: DataFrame, measure: Measure) -> DataFrame:
    """(node, rep, n, text, sketch) of the nodes of `asked` (node, rep, n), each with the text of its representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets([t or "" for t in part.column("text").to_pylist()], measure.k, measure.seed))
                # a doc_id of several rows may have other texts
                own = [_set_hashes(hashes, measure.seed)[0] == node for hashes, node in zip(sets, part.column("node").to_pylist(), strict=True)]
                sketches = pa.array([filter_sketch(x) for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "rep", "n", "text")), sketches], names=["node", "rep", "n", "text", "sketch"]).filter(pa.array(own, pa.bool_()))

    found = docs.join(asked, docs.doc_id == asked.rep).select("node", "rep", "n", "text")
    return found.mapInArrow(run, "node long, rep long, n long, text string, sketch binary").dropDuplicates(["node"])


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _key_rows(docs: DataFrame, measure: Measure, buckets: int, fine: bool = False) -> DataFrame:
    """(bucket, direct, records) of the documents' keys, of the finest cut if `fine`; a set that this task has just seen gives no second records.
    Documents of a key beyond the first FREQUENT + 1 of a task are `direct`, in buckets by document."""

    def packed(keys: np.ndarray, flags: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((nodes, keys))
        keys, flags, nodes = keys[order], flags[order], nodes[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        place = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
        direct = place > FREQUENT
        bucket = ((keys >> U64(32)) * U64(buckets)) >> U64(32)
        salted = ((mix(nodes.view(U64)) >> U64(32)) * U64(buckets)) >> U64(32)
        out: list[tuple[int, bool, bytes]] = []
        for chosen, to, is_direct in ((np.flatnonzero(~direct), bucket, False), (np.flatnonzero(direct), salted, True)):
            if not len(chosen):
                continue
            chosen = chosen[np.argsort(to[chosen], kind="stable")]
            records = np.zeros(len(chosen), RECORD)
            low = (keys[chosen] & U64(2**38 - 1)) << U64(2) | flags[chosen]
            records["low"], records["high"], records["node"] = low & U64(2**32 - 1), low >> U64(32), nodes[chosen]
            cuts = np.flatnonzero(np.concatenate(([True], to[chosen][1:] != to[chosen][:-1])))
            for x, y in zip(cuts, np.append(cuts[1:], len(chosen)), strict=True):
                # direct records come after the buckets of their keys
                own = bucket[chosen[x:y]].astype("<u8").tobytes() if is_direct else b""
                out.append((int(to[chosen[x]]), is_direct, own + records[x:y].tobytes()))
        b, d, r = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(d), pa.array(r, pa.binary())], names=["bucket", "direct", "records"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        flags: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        held = 0
        for _, texts in id_text_batches(batches):
            for hashes in shingle_sets(texts, measure.k, measure.seed):
                node = _set_hashes(hashes, measure.seed)[0]
                if not len(hashes) or node in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()  # only saves work: equal records are merged later
                seen.add(node)
                for band, found, thin in [(0, mix(hashes + U64(1)), False)] if fine else join_keys(hashes, measure):
                    keys.append(found)
                    flags.append(np.full(len(found), (band & 1) << 1 | thin, U64))
                    nodes.append(np.full(len(found), node, np.int64))
                    held += len(found)
                if held > HELD_KEYS:
                    yield packed(np.concatenate(keys), np.concatenate(flags), np.concatenate(nodes))
                    keys, flags, nodes, held = [], [], [], 0
        if keys:
            yield packed(np.concatenate(keys), np.concatenate(flags), np.concatenate(nodes))

    return docs.select("text").mapInArrow(run, "bucket long, direct boolean, records binary")


def _repeated_keys(most: int):
    """From rows sorted by bucket: (key, node, band, thin, frequent) of keys of several documents; `band` is its parity,
    `frequent` are keys of more than `most`."""

    def rows(bucket: np.ndarray, records: np.ndarray, frequent: np.ndarray | None) -> pa.RecordBatch:
        low = records["high"].astype(np.int64) << 32 | records["low"]
        key, nodes = bucket << 39 | low >> 1, records["node"]  # the parity of the band belongs to the key
        order = np.lexsort((nodes, key))
        key, nodes, low = key[order], nodes[order], low[order]
        if frequent is None:
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (nodes[1:] != nodes[:-1])
            key, nodes, low = key[new], nodes[new], low[new]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            counts = np.diff(np.append(starts, len(key)))
            many = np.repeat(counts, counts)
            key, nodes, low, many = key[many > 1], nodes[many > 1], low[many > 1], many[many > 1]
            frequent = many > most
        columns = [pa.array(key), pa.array(nodes), pa.array((low >> 1 & 1).astype(np.int32)), pa.array((low & 1).astype(bool)), pa.array(frequent)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "node", "band", "thin", "frequent"])

    def run(sorted_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in sorted_batches:
            for bucket, direct, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "direct", "records")), strict=True):
                if bucket != now and held:
                    yield rows(np.int64(now), np.concatenate(held), None)
                    held = []
                now = bucket
                if direct:
                    n = len(data) // (8 + RECORD.itemsize)
                    own = np.frombuffer(data, "<u8", n).astype(np.int64)
                    yield rows(own, np.frombuffer(data, RECORD, n, 8 * n), np.ones(n, bool))
                else:
                    held.append(np.frombuffer(data, RECORD))
        if held:
            yield rows(np.int64(now), np.concatenate(held), None)

    return run


def _partnered(measure: Measure):
    """Of rows (node, n, band, keys, frequent, thin), the counts being of keys that are not the document's alone: (node,
    band, heavy) of documents that may have partners; heavy ones cannot leave their frequent keys out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, parity, keys, frequent = (batch.column(c).to_numpy() for c in ("n", "band", "keys", "frequent"))
            thin = batch.column("thin").to_numpy(zero_copy_only=False)
            own = measure.own_band(n)
            spare = measure.spare(own + (own % 2 != parity))
            out = pa.RecordBatch.from_arrays([batch.column("node"), batch.column("band"), pa.array(thin | (frequent > spare))], names=["node", "band", "heavy"])
            yield out.filter(pa.array(thin | (keys > spare)))

    return run


def _repeated(docs: DataFrame, shingles: int, measure: Measure, fine: bool = False) -> DataFrame:
    """(key, node, band, thin, frequent): the keys of several documents, written; `shingles` is their number in all."""
    spark = docs.sparkSession
    rate = 1 if fine else 5 * (100 - measure.percent) / (100 + measure.percent)  # keys a shingle, about
    buckets = max(LEAST_BUCKETS, int(shingles * rate // BUCKET_KEYS))
    tasks = max(buckets // 64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = _key_rows(docs, measure, buckets, fine).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = materialise(dealt.mapInArrow(_repeated_keys(FREQUENT), "key long, node long, band int, thin boolean, frequent boolean"), "repeated")
    free_shuffles(spark)
    return found


def _partners(repeated: DataFrame, nodes: DataFrame, measure: Measure) -> tuple[DataFrame, DataFrame]:
    """(key, node, band, frequent) of documents that may have partners, and (node, band) of the heavy ones among them. A
    record that two tasks gave counts twice, which only keeps more."""
    counts = repeated.groupBy("node", "band").agg(F.count("*").alias("keys"), F.sum(F.col("frequent").cast("long")).alias("frequent"), F.max("thin").alias("thin"))
    sized = counts.join(nodes.select("node", "n"), "node").select("node", "n", "band", "keys", "frequent", "thin")
    found = materialise(sized.mapInArrow(_partnered(measure), "node long, band int, heavy boolean"), "partnered")
    kept = materialise(repeated.join(found, ["node", "band"]).filter("heavy or not frequent").select("key", "node", "band", "frequent"), "kept")
    return kept, found.filter("heavy").select("node", "band")


def _meetings(kept: DataFrame, heavy: DataFrame, candidates: DataFrame, measure: Measure) -> DataFrame:
    """(key, node): the keys under which documents meet."""
    again = candidates.join(heavy.select("node").distinct(), "node", "left_semi")
    fine = _repeated(again.select("text"), again.agg(F.sum("n")).first()[0] or 0, measure, fine=True)
    crowded = fine.filter("frequent").select("key", "node").distinct().groupBy("node").agg(F.count("*").alias("keys")).join(candidates.select("node", "n"), "node")
    crowd = crowded.filter(F.col("keys") * 100 >= F.col("n") * measure.percent).select("node")
    met = (
        kept.filter("not frequent").select("key", "node")
        .unionAll(fine.filter("not frequent").select("key", "node"))
        .unionAll(kept.filter("frequent").join(crowd, "node", "left_semi").select("key", "node"))
    )
    found = materialise(met, "meetings")
    discard(fine)
    return found


def _shared_keys(hubs: int):
    """From rows sorted by key, those of one node side by side: rows (key, node, hub, place) of every member of a key with each of the key's first
    `hubs` members before it; place is the member's position from 0. A key may run through many batches; only its first
    members and its last one are held."""

    def run(sorted_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, first, count = None, None, np.zeros(0, np.int64), 0  # of the key that the last batch ended in
        for batch in sorted_batches:
            keys, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
            if len(keys) and key == keys[0] and last == nodes[0]:
                new[0] = False
            keys, nodes = keys[new], nodes[new]
            if not len(keys):
                continue
            begins = np.ones(len(keys), bool)
            begins[1:] = keys[1:] != keys[:-1]
            starts = np.flatnonzero(begins)
            start = starts[np.cumsum(begins) - 1]
            if key == keys[0]:
                start = np.where(start == 0, -count, start)
            place = np.arange(len(keys)) - start
            for j in range(hubs):
                at = np.flatnonzero(place > j)
                if not len(at):
                    break
                where = start[at] + j
                hub = np.where(where < 0, first[min(j, len(first) - 1)] if len(first) else 0, nodes[np.maximum(where, 0)])
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(nodes[at]), pa.array(hub), pa.array(place[at])], names=["key", "node", "hub", "place"])
            own = nodes[max(start[-1], 0) :][:hubs]
            first = np.concatenate((first, own))[:hubs] if start[-1] < 0 else own
            key, last, count = keys[-1], nodes[-1], int(place[-1]) + 1

    return run


def _distances(measure: Measure):
    """(node, hub, node_rep, hub_rep, near, in_family) of pairs with sizes and sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("sketch_a"), batch.column("sketch_b")
            apart = np.fromiter((hamming(x[i].as_py(), y[i].as_py()) for i in range(len(batch))), np.int64, len(batch))
            sizes = batch.column("n_a").to_numpy()
            columns = [batch.column(c) for c in ("a", "b", "rep_a", "rep_b")]
            tests = [pa.array(measure.settled(sizes, apart)), pa.array(measure.in_family(sizes, apart))]
            yield pa.RecordBatch.from_arrays([*columns, *tests], names=["node", "hub", "node_rep", "hub_rep", "near", "in_family"])

    return run


class _Union(dict):
    """Union-find over document ids; the smallest is the root."""

    def __missing__(self, x: int) -> int:
        return x

    def root(self, x: int) -> int:
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def _links_inside(ids: list[int], texts: list[str], components: list[int], rows: list[bool], measure: Measure) -> list[tuple[int, int]]:
    """Links between documents of different components that join these: of each document for which `rows` is true with every other."""
    sets = list(shingle_sets(texts, measure.k, measure.seed))
    sizes = np.array([len(x) for x in sets], np.int64)
    words = max(FILTER_BITS, 1 << int(4 * sizes.max(initial=1)).bit_length()) // 64
    sketches = np.stack([parity_words(x, words) for x in sets]) if sets else np.zeros((0, words), U64)
    union = _Union(zip(ids, components, strict=True))
    for c in components:
        union[c] = c
    out = []
    for i in range(len(ids)):
        others = np.arange(i) if rows[i] else np.flatnonzero(np.array(rows[:i], bool))  # later rows look back at this one
        if not len(others):
            continue
        apart = np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        for j in others[apart <= measure.most_apart(sizes[others] + sizes[i])].tolist():
            if union.root(ids[i]) != union.root(ids[j]) and measure.linked(sets[i], sets[j]):
                union.join(ids[i], ids[j])
                out.append((ids[i], ids[j]))
    return out


def _compare(members: DataFrame, keys: list[str], measure: Measure) -> DataFrame:
    """(u, v): links inside each group of `members` (keys, doc_id, text, component, row), groups being of bounded size."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("doc_id", "text", "component", "row")), strict=True))
        links = _links_inside(*(list(x) for x in zip(*rows, strict=True)), measure)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return members.select(*keys, "doc_id", "text", "component", "row").groupBy(*keys).applyInArrow(run, "u long, v long")


def _families(met: DataFrame, nodes: DataFrame, measure: Measure) -> DataFrame:
    """(node, component): the family of every representative that may have links."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("rep").alias(f"rep_{c}"), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    order = materialise(met.groupBy("node").agg((-F.count("*")).alias("order")), "order")
    first = met.join(order, "node").groupBy("key").agg(F.min(F.struct("order", "node"))["node"].alias("hub"))
    shared = materialise(met.join(first, "key").filter("node <> hub").select("key", "node", "hub", F.lit(1).cast("long").alias("place")), "shared")
    edges: DataFrame | None = None
    steps: list[DataFrame] = []
    hubs = 1
    while True:
        pairs = shared.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        sized = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "rep_a", "rep_b", "n_a", "sketch_a", "sketch_b")
        compared = materialise(sized.mapInArrow(_distances(measure), "node long, hub long, node_rep long, hub_rep long, near boolean, in_family boolean"), "compared")
        steps.append(compared)
        close = compared.filter("in_family").select(F.col("node_rep").alias("u"), F.col("hub_rep").alias("v"))
        edges = close if edges is None else edges.unionAll(close)
        # Members beyond the reach of every hub of their key meet again, under four times as many hubs, unless one hub's
        # family has all of them.
        seen = shared.join(compared, ["node", "hub"]).select("key", "node", "hub", "place", "near", "in_family")
        beyond = seen.groupBy("key", "node").agg(F.max("near").alias("near"), F.max("place").alias("place")).filter((F.col("place") >= hubs) & ~F.col("near")).select("key", "node")
        covered = seen.filter("in_family").join(beyond, ["key", "node"]).groupBy("key", "hub").count().groupBy("key").agg(F.max("count").alias("covered"))
        open_keys = beyond.groupBy("key").count().join(covered, "key", "left").filter("covered is null or covered < count").select("key")
        hubs *= 4
        again = beyond.join(open_keys, "key").join(order, "node").repartition("key").sortWithinPartitions("key", "order", "node").select("key", "node")
        then, shared = shared, materialise(again.mapInArrow(_shared_keys(hubs), "key long, node long, hub long, place long"), "shared")
        discard(then)
        free_shuffles(met.sparkSession)
        if not shared.take(1):
            discard(shared)
            break
    # A document and its hubs become a star around the least of them before the components are sought: a row or two a
    # document, however many hubs a crowded family has. A document has no more hubs than keys.
    stars = edges.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("others"))
    thinned = stars.select(F.explode(F.array_append("others", F.col("u"))).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    found = connected_components(thinned)
    for step in [*steps, order]:
        discard(step)
    return found


def components(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`; component_id is the smallest doc_id reachable by links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    while True:
        sets = materialise(_set_rows(docs, measure), "sets")
        with_words = sets.filter("n_shingles > 0 and doc_id is not null")
        nodes = materialise(
            with_words.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.min("check").alias("low"), F.max("check").alias("high")), "nodes"
        )
        if not nodes.filter("low <> high").take(1):
            break
        discard(sets), discard(nodes)
        measure = Measure(measure.k, measure.percent, measure.seed + 1)  # two sets with one hash

    repeated = _repeated(docs.filter("doc_id is not null"), nodes.agg(F.sum("n")).first()[0] or 0, measure)
    kept, heavy = _partners(repeated, nodes, measure)
    discard(repeated)
    free_shuffles(docs.sparkSession)
    asked = materialise(kept.select("node").distinct().join(nodes.select("node", "rep", "n"), "node"), "asked")  # its size is known then
    with bloom_joins(docs.sparkSession):
        candidates = materialise(_with_texts(docs, asked.filter("n > 0"), measure), "candidates")  # of which a filter can be made
    free_shuffles(docs.sparkSession)
    met = _meetings(kept, heavy, candidates, measure)
    free_shuffles(docs.sparkSession)
    discard(kept), discard(heavy), discard(asked)
    family = _families(met, candidates, measure).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    discard(met)
    free_shuffles(docs.sparkSession)

    # The families' members, in chunks by the hash of their id; every chunk also gets the family's first members.
    some = [F.min("rep"), *[F.min_by("rep", F.xxhash64("rep", F.lit(i))) for i in range(1, FIRST)]]
    chunks = lambda n: F.ceil(F.greatest(F.count("*") / CHUNK, F.sum(n) / CHUNK_SHINGLES)).cast("int")
    family = family.join(candidates.select("rep", "n"), "rep")
    counts = family.groupBy("family").agg(chunks("n").alias("chunks"), F.array(*some).alias("first"))
    placed = family.join(counts, "family")
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("chunks")).cast("int")
    everywhere = F.when(F.array_contains("first", F.col("rep")), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.col("own")))
    placed = placed.withColumn("own", own).select("rep", "n", "family", "chunks", "own", everywhere.alias("everywhere"))
    members = materialise(placed.join(candidates.select("rep", "n", "text"), ["rep", "n"]).withColumnRenamed("rep", "doc_id"), "members")
    discard(candidates)
    free_shuffles(docs.sparkSession)
    alone = members.withColumn("chunk", F.explode("everywhere")).withColumns({"component": F.col("doc_id"), "row": F.lit(True)})
    edges = materialise(_compare(alone, ["family", "chunk"], measure), "links")
    found = connected_components(edges)

    # Families of several chunks that are not one component yet: what lies outside the largest one meets every chunk.
    placed = members.filter("chunks > 1").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = placed.groupBy("family", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("kinds")).filter("kinds > 1")
    split = materialise(placed.join(largest, "family"), "split")
    if split.take(1):
        outside = split.filter("component <> largest")
        blocks = outside.groupBy("family").agg(chunks("n").alias("blocks"))
        block = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("blocks")).cast("int")
        to_meet = split.join(blocks, "family").withColumn("chunk", F.col("own")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("row", F.lit(False))
        meeting = outside.join(blocks, "family").withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("row", F.lit(True))
        columns = ["family", "chunk", "block", "doc_id", "text", "component", "row"]
        # a document that meets its own chunk is there once, as one of the rows
        both = meeting.select(*columns).unionAll(to_meet.filter((F.col("component") == F.col("largest")) | (F.col("block") != block)).select(*columns))
        more = materialise(_compare(both, ["family", "chunk", "block"], measure), "links")
        if more.take(1):
            found = connected_components(edges.unionAll(more))

    discard(members), discard(edges)
    root = nodes.select("node", "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    root = root.select("node", F.coalesce("component", "rep").alias("component_id"))
    return sets.select("doc_id", "n_shingles", "node").join(root, "node", "left").select(
        "doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """`docs` without the documents that are linked to one of smaller doc_id; of rows with one doc_id, one stays."""
    found = materialise(components(docs, measure).filter("doc_id <> component_id").select("doc_id").distinct(), "linked")
    several = materialise(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "several")

    def first_rows(rows: DataFrame) -> DataFrame:
        w = W.partitionBy("doc_id").orderBy(F.xxhash64(*rows.columns))
        left = rows.join(found, "doc_id", "left_anti")
        ranked = left.join(several, "doc_id", "left_semi").withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")
        return left.join(several, "doc_id", "left_anti").unionByName(ranked)  # most rows need no order

    return behind_plain_names(docs, first_rows, ["nth"])
