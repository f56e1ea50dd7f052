"""Near duplicates by an exact Jaccard join of word shingles.

Rare-first prefix filtering: the shingles of a class of equal sets are ordered by how many
classes hold them, and two classes that are similar enough share one in their prefixes. Length,
positional and suffix filters thin the candidates, and a pair is verified once.

1. `shingle_sets`: set size and fingerprint of every document; equal sets are one class.
2. `_postings`: every class's shingles go, as compressed blocks of sorted hashes, to the task of
   their hash range, which counts the classes of each. A shingle of one class links nothing.
3. `_lists`: the shared shingles of a class come back together, in rare-first order. Shingles of
   one class fill a prefix first, so most classes have nothing left to look for and drop out.
4. Classes are gathered into neighbourhoods by the prefix shingles they share. All pairs of a
   neighbourhood are verified, in blocks of two pieces of bounded size.
5. Pairs that share a prefix shingle across neighbourhoods are verified in such blocks too, at the
   first shingle that their prefixes share. So every candidate pair is verified once.
6. A block counts the links of its classes and connects them, so no table of pairs is written.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gabarito.llm.common import slices
from gabarito.llm.components import components
from gabarito.staging import staged

WORDS = 5
# A pair links when PERCENT[1] * intersection >= PERCENT[0] * union.
PERCENT = (75, 100)
BLOCKS = 64  # hash ranges, at least
SHINGLES_PER_BLOCK = 8_000_000
SHINGLES_PER_FLUSH = 1_000_000
CLASS_BYTES = 12
NEIGHBOURS = 512  # classes of a piece of a neighbourhood
BLOCK_ROWS = 256  # classes of one side of a block of a shingle
SET_BYTES = 4 << 20  # and the bytes of their sets
ROUNDS = 3  # of gathering classes into neighbourhoods


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(texts: list[str | None], words: WordHashes) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; none for one without words."""
    # Bytes lower only A-Z, and split at blanks and the control characters 9 to 13.
    split = [t.encode().lower().split() if t else [] for t in texts]
    counts = np.array([len(ws) for ws in split], np.int64)
    flat = np.fromiter(map(words.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum()))
    rolled = np.zeros(max(0, len(flat) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        rolled = mixed(rolled + flat[k : k + len(rolled)] + np.uint64(k + 1))
    out, begin = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(rolled[begin : begin + n - WORDS + 1]))
        elif n:
            short = np.full(1, n << 32, np.uint64)
            for k in range(n):
                short = mixed(short + flat[begin + k : begin + k + 1] + np.uint64(k + 1))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        begin += n
    return out


def class_of(hashes: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(hashes.tobytes(), digest_size=CLASS_BYTES).digest()


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id_col`, `n_shingles` and the fingerprint `class` (null for an empty set) of every row."""
    rows = docs.select(id_col, text_col)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingle_hashes(part.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["id", "n_shingles", "class"],
                )

    return rows.mapInArrow(run, f"id {kind}, n_shingles long, class binary")


def packed(array: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    import zstandard

    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(raw: bytes, dtype: type, n: int) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, n).T).view(dtype).reshape(-1)


BLOB = "block int, n long, classes binary, hashes binary, owners binary, counts binary"
BLOB_NAMES = [x.split()[0] for x in BLOB.split(", ")]
BLOB_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
CLASS = np.dtype([("id", f"V{CLASS_BYTES}"), ("n", "<u4")])


def blob(block: int, classes: np.ndarray, hashes: np.ndarray, owners: np.ndarray, counts: np.ndarray) -> tuple:
    """One row for a part of a block: entries in order of hash, owners being places in `classes`."""
    used, owners = np.unique(owners, return_inverse=True)
    deltas = np.diff(hashes, prepend=np.uint64(0))
    small = np.uint16 if len(used) < 1 << 16 else np.uint32
    return (block, len(hashes), classes[used].tobytes(), packed(deltas), packed(owners.astype(small)), packed(counts))


def entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    classes = np.frombuffer(row["classes"], CLASS)
    n = row["n"]
    small = np.uint16 if len(classes) < 1 << 16 else np.uint32
    return classes, np.cumsum(unpacked(row["hashes"], np.uint64, n)), unpacked(row["owners"], small, n), unpacked(row["counts"], np.uint32, n)


def batch_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def range_of(values: np.ndarray, blocks: int) -> np.ndarray:
    return (((values >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def in_blocks(classes: np.ndarray, hashes: np.ndarray, owners: np.ndarray, counts: np.ndarray, to: np.ndarray, blocks: int) -> Iterator[tuple]:
    order = np.lexsort((hashes, to))
    hashes, owners, counts = hashes[order], owners[order], counts[order]
    cuts = np.searchsorted(to[order], np.arange(blocks + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield blob(b, classes, *(x[cuts[b] : cuts[b + 1]] for x in (hashes, owners, counts)))


def _postings(docs: DataFrame, text_col: str, blocks: int) -> DataFrame:
    """All classes' shingles as blobs, one row for each block and flush of a task."""

    def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
        classes = np.array([(class_of(s), len(s)) for s in held], CLASS)
        sizes = np.array([len(s) for s in held])
        hashes = np.concatenate(held)
        owners = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
        to = range_of(hashes, blocks)
        return batch_of(list(in_blocks(classes, hashes, owners, np.ones(len(hashes), np.uint32), to, blocks)), BLOB_NAMES, BLOB_TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, total = WordHashes(), {}, 0
        for batch in batches:
            for part in slices(batch, 0):
                for s in shingle_hashes(part.column(0).to_pylist(), words):
                    key = s.tobytes() if len(s) < 4 else class_of(s)
                    if len(s) and key not in held:
                        held[key], total = s, total + len(s)
                if total > SHINGLES_PER_FLUSH:
                    yield flushed(list(held.values()))
                    held, total = {}, 0
        if held:
            yield flushed(list(held.values()))

    return docs.select(text_col).mapInArrow(run, BLOB)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Each block's entries, with a class's number in the block for its owner."""
    held: list[dict] = []

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        parts = [entries(r) for r in held]
        classes, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        starts = np.cumsum([0] + [len(p[0]) for p in parts])
        number = number.astype(np.int32)
        owners = np.concatenate([number[s + p[2].astype(np.int64)] for s, p in zip(starts, parts)])
        return classes, np.concatenate([p[1] for p in parts]), owners, np.concatenate([p[3] for p in parts])

    for batch in batches:
        for row in batch.to_pylist():
            if held and row["block"] != held[0]["block"]:
                yield joined()
                held = []
            held.append(row)
    if held:
        yield joined()


def grouped(blobs: DataFrame, blocks: int) -> DataFrame:
    return blobs.repartition(blocks, "block").sortWithinPartitions("block")


def _shared(blobs: DataFrame, blocks: int) -> DataFrame:
    """Shingles of two or more classes with the number of classes, dealt by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for classes, hashes, owners, _ in by_block(batches):
            order = np.lexsort((owners, hashes))
            hashes, owners = hashes[order], owners[order]
            fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])]
            hashes, owners = hashes[fresh], owners[fresh]
            first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            counts = np.diff(np.r_[first, len(hashes)])
            counts = np.repeat(counts, counts)
            many = counts > 1
            if not many.any():
                continue
            hashes, owners, counts = hashes[many], owners[many], counts[many].astype(np.uint32)
            home = np.ascontiguousarray(classes["id"]).view(np.uint8).reshape(len(classes), -1)[:, :4]
            home = np.ascontiguousarray(home).view("<u4").reshape(-1).astype(np.uint64) << np.uint64(32)
            rows = list(in_blocks(classes, hashes, owners, counts, range_of(home, blocks)[owners], blocks))
            yield batch_of(rows, BLOB_NAMES, BLOB_TYPES)

    return grouped(blobs, blocks).mapInArrow(run, BLOB)


def prefix(n: np.ndarray) -> np.ndarray:
    """Length of the prefix of a set of `n`: one more than it can miss and still be similar."""
    return n + (-PERCENT[0] * n) // PERCENT[1] + 1


LIST = "class binary, n long, shingles binary, counts binary, prefix array<long>"


def _lists(shared: DataFrame, blocks: int) -> DataFrame:
    """Classes with shared shingles in their prefix: these in rare-first order, all shared ones after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in LIST.split(", ")]
        types = [pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        for classes, hashes, owners, counts in by_block(batches):
            order = np.lexsort((hashes, counts, owners))
            hashes, owners, counts = hashes[order], owners[order], counts[order]
            cuts = np.searchsorted(owners, np.arange(len(classes) + 1))
            n = classes["n"].astype(np.int64)
            looks = prefix(n) - (n - np.diff(cuts))
            rows = []
            for k in np.flatnonzero(looks > 0).tolist():
                own = slice(cuts[k], cuts[k + 1])
                rows.append((classes["id"][k].tobytes(), int(n[k]), hashes[own].tobytes(), counts[own].tobytes(), hashes[own][: looks[k]].view(np.int64).tolist()))
                if len(rows) == 1000:
                    yield batch_of(rows, names, types)
                    rows = []
            if rows:
                yield batch_of(rows, names, types)

    return grouped(shared, blocks).mapInArrow(run, LIST)


class Ranked:
    """Classes of one task with their shared shingles as ranks in the common rare-first order."""

    def __init__(self, rows: list[dict]):
        self.ids = [r["cid"] for r in rows]
        self.n = np.array([r["n"] for r in rows], np.int64)
        raw = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        values, first, place = np.unique(np.concatenate(raw), return_index=True, return_inverse=True)
        counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows])[first]
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, counts))] = np.arange(len(values))
        self.values, self.rank_of_value, self.flat, self.total = values, rank, rank[place], len(values)
        looks = self.n - self.sizes  # shingles that no other class has, ahead of all shared ones
        self.prefixes = np.minimum(prefix(self.n) - looks, self.sizes)
        self.mark = np.zeros(self.total, bool)

    def list_of(self, k: int) -> np.ndarray:
        return self.flat[self.starts[k] : self.starts[k] + self.sizes[k]]

    def rank(self, value: int) -> int:
        return int(self.rank_of_value[np.searchsorted(self.values, np.uint64(value & (1 << 64) - 1))])

    def gathered(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The first `sizes` ranks of each row, end to end."""
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - sizes), sizes)]

    def similar(self, x: int, rows: np.ndarray, only_rank: int | None = None) -> np.ndarray:
        """Those of `rows` that link with `x`; with `only_rank`, if that is the first prefix shingle of both."""
        a, b = PERCENT
        n = self.n
        rows = rows[b * np.minimum(n[rows], n[x]) >= a * np.maximum(n[rows], n[x])]  # length
        if not len(rows):
            return rows
        own = self.list_of(x)
        self.mark[own[: self.prefixes[x]]] = True
        sizes = self.prefixes[rows]
        ranks = self.gathered(rows, sizes)
        hit = self.mark[ranks]
        self.mark[own[: self.prefixes[x]]] = False
        begin = np.cumsum(sizes) - sizes
        at = np.arange(len(ranks)) - np.repeat(begin, sizes)
        first = np.minimum.reduceat(np.where(hit, at, self.total + len(ranks)), begin)
        shares = first < sizes
        rows, first, begin = rows[shares], first[shares], begin[shares]
        common = ranks[begin + first]
        if only_rank is not None:
            keep = common == only_rank
            rows, first, common = rows[keep], first[keep], common[keep]
        if not len(rows):
            return rows
        least = -((-a * (n[rows] + n[x])) // (a + b))
        ahead = np.searchsorted(own, common)
        fits = np.minimum(self.sizes[rows] - first, len(own) - ahead) >= least  # positional
        rows, least = rows[fits], least[fits]
        if not len(rows):
            return rows
        sizes = self.sizes[rows]
        ranks = self.gathered(rows, sizes)
        begin = np.cumsum(sizes) - sizes
        middle = own[len(own) // 2]
        below = np.add.reduceat((ranks < middle).astype(np.int64), begin)
        own_below = int(np.searchsorted(own, middle))
        bound = np.minimum(below, own_below) + np.minimum(sizes - below, len(own) - own_below)
        self.mark[own] = True
        overlap = np.add.reduceat(self.mark[ranks].astype(np.int64), begin)
        self.mark[own] = False
        union = n[rows] + n[x] - overlap
        return rows[(bound >= least) & (b * overlap >= a * union)]  # suffix, then the exact test


LINK = "a long, b long, n_links long"
LINK_NAMES = [x.split()[0] for x in LINK.split(", ")]


class Linked:
    """Links among the classes of one block, which are numbered in order of `cid`."""

    def __init__(self, rows: list[dict]):
        self.rows = sorted({r["cid"]: r for r in rows}.values(), key=lambda r: r["cid"])
        self.sets = Ranked(self.rows)
        self.copies = np.array([r["copies"] for r in self.rows], np.int64)
        self.n_links = np.zeros(len(self.rows), np.int64)
        self.least = np.arange(len(self.rows))

    def verify(self, x: int, others: np.ndarray, only_rank: int | None = None) -> None:
        if not len(others):
            return
        found = self.sets.similar(x, others, only_rank)
        if not len(found):
            return
        self.n_links[x] += self.copies[found].sum()
        self.n_links[found] += self.copies[x]
        met = np.unique(np.append(self.least[found], self.least[x]))
        if len(met) > 1:
            self.least[np.isin(self.least, met)] = met[0]

    def out(self) -> list[tuple[int, int, int]]:
        """Every class with links, the least one it is connected with here, and the rows it links with."""
        ids = self.sets.ids
        return [(ids[k], ids[self.least[k]], int(self.n_links[k])) for k in np.flatnonzero(self.n_links).tolist()]


def linked_in(rows: list[dict]) -> list[tuple[int, int, int]]:
    """All pairs between pieces `i` and `j` of a neighbourhood, or within one where they are the same."""
    block = Linked(rows)
    i, j = rows[0]["i"], rows[0]["j"]
    own = np.array([r["own"] for r in block.rows])
    right = np.flatnonzero(own == j)
    for x in np.flatnonzero(own == i).tolist():
        block.verify(x, right[right > x] if i == j else right)
    return block.out()


def linked_over_shingle(rows: list[dict]) -> list[tuple[int, int, int]]:
    """Pairs of a left and a right row that lie in different neighbourhoods, if `key` is the first shingle their prefixes share.

    Rows outside the most common neighbourhood are left somewhere and right somewhere, so
    two of them count where the smaller one is left.
    """
    block = Linked(rows)
    at = {r["cid"]: k for k, r in enumerate(block.rows)}
    rank = block.sets.rank(rows[0]["key"])
    label = np.array([r["label"] for r in block.rows])
    outside = np.array([r["outside"] for r in block.rows])
    right = np.array(sorted({at[r["cid"]] for r in rows if not r["left"]}), np.int64)
    for x in sorted({at[r["cid"]] for r in rows if r["left"]}):
        block.verify(x, right[(label[right] != label[x]) & (~outside[right] | (right > x))], rank)
    return block.out()


def links_by(rows: DataFrame, keys: list[str], linked) -> DataFrame:
    """`linked` over each group of rows with equal keys; groups are bounded by their makers."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None

        def out() -> pa.RecordBatch | None:
            found = linked(held) if len(held) > 1 else []
            return batch_of(found, LINK_NAMES, [pa.int64()] * 3) if found else None

        for batch in batches:
            for row in batch.to_pylist():
                here = [row[k] for k in keys]
                if here != key and held:
                    if (links := out()) is not None:
                        yield links
                    held = []
                key = here
                held.append(row)
        if held and (links := out()) is not None:
            yield links

    return rows.repartition(partitions, *keys).sortWithinPartitions(*keys).mapInArrow(run, LINK)


def pieces_for(rows: str, size: str, per: int):
    """How many pieces keep rows and bytes of a group bounded."""
    return F.greatest(F.ceil(F.col(rows) / per), F.ceil(F.col(size) / SET_BYTES), F.lit(1)).cast("int")


def class_links(lists: DataFrame, copies: DataFrame) -> DataFrame:
    """(a, b, n_links): a class of `lists` (with `cid`), one it is connected with, and rows it links with.

    Every pair of linked classes is counted in one row of either class, by the `copies` of the
    other, and the pairs (a, b) connect what the links connect.
    """
    postings = staged(lists.select("cid", F.col("n"), F.explode("prefix").alias("shingle")), "postings")

    # Neighbourhoods: the least class within a few steps over shared prefix shingles.
    labels = postings.select("cid", "shingle", F.col("cid").alias("label"))
    for _ in range(ROUNDS):
        least = labels.groupBy("shingle").agg(F.min("label").alias("label"))
        label = postings.join(least, "shingle").groupBy("cid").agg(F.min("label").alias("label"))
        labels = postings.join(label, "cid").select("cid", "shingle", "label")
    label = staged(label.join(copies, "cid"), "neighbourhoods")
    size = F.octet_length("shingles") + F.octet_length("counts")
    sizes = lists.select("cid", size.alias("bytes"))
    sets = lists.select("cid", "n", "shingles", "counts")

    # All pairs of a neighbourhood: a class goes to the blocks of its piece with every piece.
    totals = (
        label.join(sizes, "cid")
        .groupBy("label")
        .agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))
        .where("rows > 1")
        .select("label", pieces_for("rows", "bytes", NEIGHBOURS).alias("pieces"))
    )
    own = F.pmod(F.xxhash64("cid"), F.col("pieces")).cast("int")
    pieces = (
        label.join(staged(totals, "totals"), "label")
        .select("cid", "copies", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
        .select("cid", "copies", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    near = links_by(pieces.join(sets, "cid"), ["label", "i", "j"], linked_in)
    return staged(near.unionByName(links_across(postings.select("cid", F.col("shingle").alias("key")).join(label, "cid"), sizes, sets)), "class-links")


def links_across(members: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a key (a prefix shingle) that differ in `label`.

    All members of a key meet those outside its most common label, in blocks.
    """
    members = staged(members, "members")
    open_ = members.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("key")
    members = staged(members.join(staged(open_, "open"), "key").join(sizes, "cid"), "members")
    plan = (
        members.groupBy("key", "label")
        .agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))
        .groupBy("key")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.max(F.struct("rows", "bytes", "label")).alias("most"),
        )
        .select(
            "key",
            F.col("most.label").alias("common"),
            (F.col("rows") - F.col("most.rows")).alias("few"),
            (F.col("bytes") - F.col("most.bytes")).alias("few_bytes"),
            pieces_for("rows", "bytes", BLOCK_ROWS).alias("rights"),
        )
        .select("key", "common", "rights", pieces_for("few", "few_bytes", BLOCK_ROWS).alias("lefts"))
    )
    dealt = members.join(staged(plan, "plan"), "key").withColumn("outside", F.col("label") != F.col("common"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    one = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    kept = ["cid", "copies", "key", "label", "outside"]
    left = dealt.where("outside").select(*kept, F.lit(True).alias("left"), one("lefts").alias("i"), F.explode(every("rights")).alias("j"))
    right = dealt.select(*kept, F.lit(False).alias("left"), F.explode(every("lefts")).alias("i"), one("rights").alias("j"))
    return links_by(left.unionByName(right).join(sets, "cid"), ["key", "i", "j"], linked_over_shingle)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `n_shingles`, `class`, `component_id` and `n_links` of every row of `docs`.

    Words are what lies between blanks and control characters 9 to 13, with A-Z lowered; a set
    is the distinct five-word shingles, or all words when there are fewer. Sets link at a
    Jaccard similarity of 0.75, `component_id` is the smallest id reachable and `n_links` the
    number of other rows that a row links with, rows of an equal set included. Null, empty or
    wordless texts have size 0, no class, no links and their own id. Equal sets are one class,
    whatever their number; repeated rows stay, with equal results. An empty table gives no rows. Other
    columns of `docs` are not read. Shingles are 64-bit and classes 96-bit hashes.
    """
    sets = staged(shingle_sets(docs, id_col, text_col), "sets")
    classes = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = max(BLOCKS, -(-total // SHINGLES_PER_BLOCK))
    lists = _lists(_shared(_postings(docs, text_col, blocks), blocks), blocks)
    lists = staged(lists.withColumn("cid", F.monotonically_increasing_id()), "lists")
    copies = staged(lists.select("class", "cid").join(classes, "class"), "copies")
    links = class_links(lists, copies.select("cid", "copies"))
    joined = components(links.select("a", "b"), "a", "b")
    counted = links.groupBy(F.col("a").alias("cid")).agg(F.sum("n_links").alias("n_links"))
    component = copies.join(joined, F.col("cid") == F.col("node"), "left").select("class", "cid", "least", F.coalesce("component", "cid").alias("component"))
    smallest = component.groupBy("component").agg(F.min("least").alias("smallest"))
    reached = component.join(smallest, "component").join(counted, "cid", "left").select("class", "smallest", "n_links")
    named = classes.join(reached, "class", "left").select(
        "class",
        F.coalesce("smallest", "least").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )
    named = staged(named, "named")  # so that only two shuffles meet below, and a hot class can be split
    columns = ["id", "n_shingles", "class", "component_id", "n_links"]
    whole = sets.where(F.col("class").isNotNull()).join(named, "class").select(columns)
    empty = sets.where(F.col("class").isNull()).withColumns({"component_id": F.col("id"), "n_links": F.lit(0).cast("long")})
    return whole.unionByName(empty.select(columns))
