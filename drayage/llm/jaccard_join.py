"""Exact Jaccard join of shingle sets by prefix index, with set relations that save most comparisons.

Sets are equal, or alike, far more often than chance has it, and that is used three times. Equal sets are one node. A token's
index list is cut into blocks by set size, and an entry skips every block that its position rules out. And each set is first
compared with leaders of its blocks only: a set that links with its leader inherits the leader's answer, the component; only
lists whose members are still in several components are opened further, for pairs across components. Components are exact:
every pair of different components that shares a prefix token and passes the bounds, all of which are necessary, is verified
on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.common import Scratch, claim, components, ship, text_slices
from drayage.llm.shingles import mixed, shingle_sets

#: At most so many frequent shingles are told to the workers, to order them last; the order never changes the result.
FREQUENT = 65_536
#: Shingles are counted in blocks of about so many; a block reports those it has met in LOCAL documents or more.
COUNTED, LOCAL = 1_000_000, 4
#: The index list of a frequent shingle is dealt to one task for about so many of its entries.
DEALT = 4096
#: Index lists of up to so many entries are looked through by the task that sorts them.
LONG = 512
#: Bins of partners' sizes; all of them. Three bins' counts share one number, in so many bits each.
BINS, EVERY, COUNT_BITS = 9, 2**9 - 1, 21
#: A task remembers so many set digests, to pass over equal sets; forgetting some costs a few repeated rows.
SEEN = 200_000
#: Index entries name a set by so many bytes of its digest and its size, and get the whole digest when most of them are gone.
SHORT = 8
#: 64-bit words of a set's parity bitmap.
WORDS = 16
#: Pairs of sets of more than LARGE shingles are held against each other by bitmaps of WIDE words before their sets are.
LARGE, WIDE = 512, 128
#: Rounds of leaders; the last ones are left out when one finds no link.
ROUNDS = 4
#: Leaders of a block of an index list.
LEADERS = 3
#: Bits of the table by which most texts that are not wanted are passed over. Its words are the rows of a broadcast: 2**18 at most.
SIFT_BITS = 24
BITS = [f"b{k}" for k in range(WORDS)]


def _binary(words: np.ndarray) -> pa.Array:
    """Rows of one or two 64-bit numbers as values of 8 or 16 bytes."""
    data = np.ascontiguousarray(words)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (8 * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _numbers(column: pa.Array) -> np.ndarray:
    size = len(column[0].as_py())
    fixed = column.cast(pa.binary(size))
    return np.frombuffer(fixed.buffers()[1], np.uint64).reshape(-1, size // 8)[fixed.offset : fixed.offset + len(fixed)]


def _nodes(doc: np.ndarray, h: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: first position of its set, size, and a 128-bit digest of the whole set."""
    n = np.bincount(doc, minlength=texts)
    first = np.cumsum(n) - n
    node = np.zeros((texts, 2), np.uint64)
    full = n > 0
    if full.any():
        for k, salt in enumerate((1, 0xD1B54A32D192ED03)):
            node[full, k] = mixed(np.add.reduceat(mixed(h + np.uint64(salt)), first[full]) ^ n[full].astype(np.uint64))
    return first, n, node


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, text number in them, shingle hash)."""
    claim(__name__)
    for part, texts in text_slices(batches, "text", 200_000, 256):
        yield part, *shingle_sets(texts, width)


def _profiles(rows: DataFrame, width: int) -> DataFrame:
    """One row for each document (doc_id, row, node, n, a parity bitmap), and rows (token, met) for shingles that a block repeats."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), *[pa.int64()] * WORDS]
    names = ["doc_id", "row", "node", "n", *BITS, "token", "met"]

    def report(held: list[np.ndarray]) -> pa.RecordBatch:
        token, met = np.unique(np.concatenate(held), return_counts=True)
        some = met >= LOCAL
        nothing = [pa.nulls(int(some.sum()), k) for k in kinds]
        return pa.RecordBatch.from_arrays([*nothing, pa.array(token[some].view(np.int64)), pa.array(met[some])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, wide = [], 0, 64 * WORDS
        for part, doc, h in _sets(batches, width):
            texts = part.num_rows
            _, n, node = _nodes(doc, h, texts)
            odd = np.bincount(doc * wide + (h % np.uint64(wide)).astype(np.int64), minlength=texts * wide) & 1
            bits = np.packbits(odd.astype(np.uint8).reshape(texts, wide), axis=1).view(np.int64)
            own = [part.column("doc_id"), part.column("row"), _binary(node), pa.array(n.astype(np.int32)), *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(WORDS))]
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(texts, pa.int64()), pa.nulls(texts, pa.int64())], names=names)
            held.append(h)
            size += len(h)
            if size >= COUNTED:
                yield report(held)
                held, size = [], 0
        if size:
            yield report(held)

    return rows.mapInArrow(run, f"doc_id long, row long, node binary, n int, {', '.join(f'{c} long' for c in BITS)}, token long, met long")


def _prefixes(rows: DataFrame, width: int, share: tuple[int, int], frequent: np.ndarray, met: np.ndarray) -> DataFrame:
    """Index entries (token, part, node, n, pos): the rarest shingles of each set, as many as a linked pair must have in common one of.

    Frequent shingles come last, by count; the others by hash. The list of a frequent shingle is in parts, by node; part is
    -1 for lists in one piece. A task enters equal sets once. `node` is the first SHORT bytes of the digest: entries are by far
    the most that is ever shuffled, and few sets have two in one partition, so each pays for its node.
    """
    order = np.argsort(frequent, kind="stable")
    known, split = frequent[order], (1 + met[order] // DEALT).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part, doc, h in _sets(batches, width):
            _, n, node = _nodes(doc, h, part.num_rows)
            at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
            hit = known[at] == h if len(known) else np.zeros(len(h), bool)
            rank = np.where(hit, order[at] + 1, 0) if len(known) else np.zeros(len(h), np.int64)
            by = np.lexsort((h, rank, doc))
            pos = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            fresh = np.zeros(len(n), bool)
            for k, x in enumerate(np.ascontiguousarray(node).view("V16").ravel().tolist()):
                if n[k] and x not in seen:
                    seen.add(x)
                    fresh[k] = True
            if len(seen) > SEEN:
                seen.clear()
            keep = fresh[doc] & (pos < (n - -(-n * share[0] // share[1]) + 1)[doc])
            own, of = doc[keep], by[keep]
            piece = np.full(len(own), -1, np.int32)
            many = hit[of] & (split[at[of]] > 1) if len(known) else np.zeros(len(own), bool)
            if many.any():
                piece[many] = (node[own[many], 1] % split[at[of[many]]]).astype(np.int32)
            made = [pa.array(h[of].view(np.int64)), pa.array(piece), _binary(node[own, : SHORT // 8]), pa.array(n[own].astype(np.int32)), pa.array(pos[keep].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(made, names=["token", "part", "node", "n", "pos"])

    return rows.select("text").mapInArrow(run, "token long, part int, node binary, n int, pos int")


def _judged(token: np.ndarray, piece: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole lists, ordered by size: the rows that have a partner of a fitting size, and the bins of their partners' sizes.

    `met` counts every partner, `near` those whose positions and own leave enough shingles for a link. Repeats go.
    """
    p, q = share
    same = np.zeros(len(token), bool)
    same[1:] = (token[1:] == token[:-1]) & (piece[1:] == piece[:-1])
    again = np.zeros(len(token), bool)
    again[1:] = same[1:] & (n[1:] == n[:-1]) & (node[1:] == node[:-1]).all(axis=1)
    rows = np.flatnonzero(~again)
    n, rest, list_of = n[rows].astype(np.int64), (n - pos)[rows].astype(np.int64), np.cumsum(~same[rows])
    met = np.where(piece[rows] >= 0, EVERY, 0).astype(np.int16)
    near = met.copy()
    at, off = np.flatnonzero(met == 0), 1
    while len(at):
        at = at[at + off < len(rows)]
        other = at + off
        at = at[(list_of[at] == list_of[other]) & (n[at] * q >= n[other] * p)]
        other = at + off
        small, large = _bins(n[other] / n[at], share), _bins(n[at] / n[other], share)
        met[at] |= small
        met[other] |= large
        both = (n[at] + n[other]) * p
        hit = (rest[at] * (p + q) >= both) & (rest[other] * (p + q) >= both)
        near[at[hit]] |= small[hit]
        near[other[hit]] |= large[hit]
        off += 1
    return rows[met != 0], met[met != 0], near[met != 0]


def _bins(ratio: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The bit of the bin of a partner's size over the own size, between share and 1 / share."""
    place = (np.log(ratio) / np.log(share[1] / share[0]) + 1) * (BINS / 2)
    return (1 << np.clip(np.floor(place), 0, BINS - 1).astype(np.int64)).astype(np.int16)


def _needed(n: Column, share: tuple[int, int]) -> list[Column]:
    """For each bin, the least number of prefix shingles that a set of n shingles has in common with a linked set of that size.

    In the order of shingles one prefix ends first; beyond its end that set has no more than its other shingles to offer, so
    a link's intersection is at most the shingles that both prefixes hold and the larger rest, which is below share * size.
    """
    p, q = share
    out = []
    for k in range(BINS):
        lo, hi = ((q / p) ** (2 * x / BINS - 1) for x in (k, k + 1))
        worst = min((p / (p + q)) * (1 + r) - (p / q) * max(1.0, r) for r in (lo, hi))
        out.append(n * float(worst) - 1e-6 * (n + 1))
    return out


def _shared(entries: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The entries that have a partner in their list, with the bins of _judged(): one shuffle, one sort, one reading.

    Lists of up to LONG entries are judged whole; in longer ones, and in those in parts, every entry counts for every bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        held, running = None, None  # the last list as far as it was read; the list that is too long to be judged
        last = None  # of a list that is too long: its last entry

        def with_bins(b: pa.RecordBatch, met: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(met), pa.array(near)], names=[*b.schema.names, "met", "near"])

        def judge(b: pa.RecordBatch) -> pa.RecordBatch:
            at, met, near = _judged(*(b.column(c).to_numpy() for c in ("token", "part")), _numbers(b.column("node")), *(b.column(c).to_numpy() for c in ("n", "pos")), share)
            return with_bins(b.take(pa.array(at)), met, near)

        def all_of(b: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal last
            if b.num_rows:
                # equal sets of several tasks come one after the other, also across batches
                token, piece, n, node = *(b.column(c).to_numpy() for c in ("token", "part", "n")), _numbers(b.column("node"))
                again = (token[1:] == token[:-1]) & (piece[1:] == piece[:-1]) & (n[1:] == n[:-1]) & (node[1:] == node[:-1]).all(axis=1)
                again = np.append(last == (token[0], piece[0], n[0], *node[0].tolist()), again)
                last = (token[-1], piece[-1], n[-1], *node[-1].tolist())
                b = b.take(pa.array(np.flatnonzero(~again)))
            every = np.full(b.num_rows, EVERY, np.int16)
            return with_bins(b, every, every)

        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b, held = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0], None
            token, piece = b.column("token").to_numpy(), b.column("part").to_numpy()
            begin = 0
            if running is not None:
                on = (token == running[0]) & (piece == running[1])
                begin = len(on) if on.all() else int(np.argmin(on))
                yield all_of(b.slice(0, begin))
                if begin == len(on):
                    continue
                running = None
            on = np.append(False, (token == token[-1]) & (piece == piece[-1]))
            end = len(token) - int(np.argmin(on[::-1]))
            if end > begin:
                yield judge(b.slice(begin, end - begin))
            if len(token) - end > LONG or piece[-1] >= 0:
                running = (token[-1], piece[-1])
                yield all_of(b.slice(end))
            else:
                held = b.slice(end)
        if held is not None:
            yield judge(held)

    dealt = entries.repartition("token", "part").sortWithinPartitions("token", "part", "n", "node")
    return dealt.mapInArrow(run, "token long, part int, node binary, n int, pos int, met short, near short")


def sifted(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """rows with __maybe: whether the 64-bit key may be among wanted(key), by a bit table of a fixed size that is broadcast."""
    slot = F.shiftrightunsigned(F.col("key"), 64 - SIFT_BITS)
    bits = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("__word")).agg(F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("__bits"))
    own = rows.withColumn("__slot", F.shiftrightunsigned(key, 64 - SIFT_BITS)).withColumn("__at", F.shiftright("__slot", 6).cast("int"))
    own = own.join(F.broadcast(bits), F.col("__at") == F.col("__word"), "left")
    hit = F.expr("shiftright(__bits, int(__slot % 64)) & 1L = 1L")
    return own.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__slot", "__at", "__word", "__bits")


def _apart(a: str, b: str) -> Column:
    """Bits in which two parity bitmaps differ."""
    return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in BITS), F.lit(0))


def _may_link(a: str, b: str, share: tuple[int, int]) -> Column:
    """Bounds on two profiles: size, and the bits in which their parities differ, each of which a differing shingle must explain."""
    p, q = share
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    # i >= p/q * (n + m - i), so n + m - 2i <= (q - p) / (q + p) * (n + m)
    return (small * q >= large * p) & (_apart(a, b) * (q + p) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (q - p))


class _Join:
    """One run: what the rounds share."""

    def __init__(self, rows: DataFrame, width: int, share: tuple[int, int], scratch: Scratch):
        self.rows, self.width, self.share, self.s = rows, width, share, scratch

    def block(self) -> Column:
        """Sets that may link are in one block of sizes or in two neighbouring ones."""
        return F.floor(F.log("n") / float(np.log(self.share[1] / self.share[0])) + 1e-9).cast("int")

    def reaches(self, n: Column, pos: Column, other: Column) -> Column:
        """Whether an entry at this position leaves shingles enough for a link with a set of `other` shingles."""
        return (n - pos) * (self.share[0] + self.share[1]) >= (n + other) * self.share[0]

    def index(self) -> None:
        s = self.s
        profile = s.cut(_profiles(self.rows, self.width), "shingle-profiles")
        counted = profile.where("token IS NOT NULL").groupBy("token").agg(F.sum("met").alias("met"))
        top = counted.orderBy(F.desc("met"), "token").limit(FREQUENT).collect()[::-1]
        frequent, met = np.array([r["token"] for r in top], np.int64).view(np.uint64), np.array([r["met"] for r in top], np.int64)
        docs = profile.where("token IS NULL")
        self.docs = s.cut(docs.select("doc_id", "row", "node", "n"), "shingle-docs")
        self.nodes = s.cut(
            docs.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("id"), F.min("row").alias("row"), *[F.min(c).alias(c) for c in ("n", *BITS)]), "shingle-nodes"
        )
        s.drop(profile)  # its bitmaps are in nodes, and the largest shuffle comes now
        shared = s.cut(_shared(_prefixes(self.rows, self.width, self.share, frequent, met), self.share), "shared-entries")
        # sets that have too few shingles in common with all sets of a size together have no link with any of them
        bit = lambda k: F.shiftright("met", k).bitwiseAND(F.lit(1)).cast("long")
        packed = [F.sum(sum((F.shiftleft(bit(3 * j + i), COUNT_BITS * i) for i in range(3)), F.lit(0))).alias(f"c{j}") for j in range(BINS // 3)]
        sums = shared.groupBy(F.col("node").alias("short"), "n").agg(F.count(F.lit(1)).alias("entries"), *packed)
        count = lambda k: F.shiftright(f"c{k // 3}", COUNT_BITS * (k % 3)).bitwiseAND(F.lit(2**COUNT_BITS - 1))
        open_ = sum((F.when(count(k) >= need, 1 << k).otherwise(0) for k, need in enumerate(_needed(F.col("n"), self.share))), F.lit(0))
        alive = F.when(F.col("entries") < 2**COUNT_BITS, open_).otherwise(EVERY)  # beyond that counts would run into one another
        sums = sums.select("short", "n", alive.alias("alive")).where("alive != 0")
        # sets that agree in the short digest and in size have each the entries of all of them: more to verify, none lost
        sums = s.cut(self.nodes.select(F.substring("node", 1, SHORT).alias("short"), "n", "node").join(sums, ["short", "n"]), "open-bins")
        kept = shared.where("near != 0").withColumnRenamed("node", "short").join(sums, ["short", "n"]).where(F.col("near").cast("int").bitwiseAND(F.col("alive")) != 0)
        self.lists = s.cut(kept.select("token", "part", "node", "n", "pos"), "index-lists")
        s.drop(shared, sums)

    def led(self, labels: DataFrame | None, seed: int) -> DataFrame:
        """Pairs (a, b) of a set and, of the leaders of its blocks that are in another component, the one with the nearest bitmap."""
        s, labelled = self.s, None
        if labels is not None:
            labelled = s.cut(self.lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled-lists")
        lists = self.lists if labelled is None else labelled
        # one shuffle for both: leaders are found where their list is, and meet it there. No value is null; saying so keeps both sides' scans alike
        lists = lists.where(" AND ".join(f"{c} IS NOT NULL" for c in lists.columns)).repartition("token", "part").withColumn("block", self.block())
        one = F.struct("node", "n", "pos", *([] if labels is None else ["component"]))
        # at first lists agree on their leaders, which most sets link with; then each has its own, so a set meets others in each list
        by = ["node"] if labels is None else ["node", "token"]
        leaders = lists.groupBy("token", "part", "block").agg(
            *[F.min(F.struct(F.xxhash64(F.lit(LEADERS * seed + k), *by).alias("h"), one.alias("one"))).alias(f"l{k}") for k in range(LEADERS)]
        )
        leaders = leaders.select("token", "part", F.col("block").alias("to"), F.explode(F.array_distinct(F.array(*[f"l{k}.one" for k in range(LEADERS)]))).alias("l"))
        own, other = ("node", "l.node") if labels is None else ("component", "l.component")
        leaders = leaders.select("token", "part", "to", F.col("l.node").alias("leader"), F.col("l.n").alias("m"), F.col("l.pos").alias("at"), F.col(other).alias("other"))
        here = (F.col("to") == F.col("block")) | (F.col("to") == F.col("block") - 1)
        met = lists.join(leaders, ["token", "part"]).where(here & (F.col(own) != F.col("other")))
        p, q = self.share
        met = met.where((F.least("n", "m") * q >= F.greatest("n", "m") * p) & self.reaches(F.col("n"), F.col("pos"), F.col("m")) & self.reaches(F.col("m"), F.col("at"), F.col("n")))
        met = s.cut(met.select(F.col("node").alias("me"), "leader").distinct(), "led")
        short = self.nodes.select("node", "n", *BITS)
        both = met.join(short.alias("x"), F.col("me") == F.col("x.node")).select(F.struct("x.*").alias("x"), "leader")
        both = both.join(short.alias("y"), F.col("leader") == F.col("y.node")).where(_may_link("x", "y", self.share))
        best = both.groupBy(F.col("x.node").alias("node")).agg(F.min(F.struct(_apart("x", "y").alias("apart"), "leader"))["leader"].alias("leader"))
        pairs = s.cut(best.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct(), "leader-pairs")
        s.drop(met, labelled)
        return pairs

    def opened(self, labels: DataFrame, tried: DataFrame) -> DataFrame:
        """Pairs (a, b) across components, of the lists that still hold several."""
        s, share = self.s, self.share
        e = s.cut(self.lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled-lists")
        several = e.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("token")
        e2 = s.cut(e.join(several, "token").withColumn("block", self.block()).join(self.nodes.select("node", *BITS), "node"), "open-entries")
        s.drop(e)
        n, pos = F.col("n"), F.col("pos")
        # the smaller set's entry looks into its own block and the next, and skips those that its position rules out
        least_next = F.ceil(F.pow(F.lit(share[1] / share[0]), F.col("block") + 1) * (1 - 1e-9))
        left = e2.where(self.reaches(n, pos, n)).withColumn("to", F.explode(F.when(self.reaches(n, pos, least_next), F.array("block", F.col("block") + 1)).otherwise(F.array("block"))))
        left, right = left.alias("l"), e2.alias("r")
        after = F.least(F.col("l.n") - F.col("l.pos"), F.col("r.n") - F.col("r.pos"))  # shingles from here on
        met = left.join(
            right,
            (F.col("l.token") == F.col("r.token"))
            & (F.col("l.to") == F.col("r.block"))
            & (F.col("l.component") != F.col("r.component"))
            & ((F.col("l.n") < F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.node") < F.col("r.node"))))
            & (after * (share[0] + share[1]) >= (F.col("l.n") + F.col("r.n")) * share[0])
            & _may_link("l", "r", share),
        )
        pairs = s.cut(met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "open-pairs")
        s.drop(e2)
        return pairs

    def texts_of(self, wanted: DataFrame, make: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
        """What make(doc, h, n, node) gives for the texts of wanted(node, key); each text is read again, most others are passed over."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[tuple[int, int]] = set()
            for b in batches:
                keys = zip(b.column("row").to_pylist(), map(hash, b.column("text").to_pylist()))
                some = [k for k, x in enumerate(keys) if x not in seen and not seen.add(x)]
                if len(seen) > SEEN:
                    seen.clear()
                for part, doc, h in _sets([b.take(pa.array(some, pa.int64()))], width):
                    _, n, node = _nodes(doc, h, part.num_rows)
                    yield make(doc, h, n, node)

        maybe = sifted(self.rows.select("row", "text"), F.col("row"), wanted.select("key")).where("__maybe").select("row", "text")
        return maybe.mapInArrow(run, schema).join(wanted, "node", "left_semi")

    def wanted(self, pairs: DataFrame) -> DataFrame:
        """(node, key, n) of the sets in pairs (a, b)."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return nodes.join(self.nodes.select("node", F.col("row").alias("key"), "n"), "node")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs that may link by wide bitmaps, which cost a fraction of their sets; pairs of sets of up to LARGE shingles stay."""
        s, (p, q) = self.s, self.share
        large = s.cut(self.wanted(pairs).where(F.col("n") > LARGE), "large-nodes")
        if large.isEmpty():
            s.drop(large)
            return pairs

        def bitmaps(doc: np.ndarray, h: np.ndarray, n: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
            some, wide = np.flatnonzero(n > LARGE), 64 * WIDE
            take = n[doc] > LARGE
            odd = np.bincount(np.searchsorted(some, doc[take]) * wide + (h[take] % np.uint64(wide)).astype(np.int64), minlength=len(some) * wide) & 1
            bits = np.packbits(odd.astype(np.uint8)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * WIDE), pa.array(bits))
            return pa.RecordBatch.from_arrays([_binary(node[some]), pa.array(n[some].astype(np.int32)), lists], names=["node", "n", "wide"])

        found = self.texts_of(large, bitmaps, "node binary, n int, wide array<long>").groupBy("node").agg(F.first("n").alias("n"), F.first("wide").alias("wide"))
        both = pairs.join(found.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa")), "a", "left")
        both = both.join(found.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb")), "b", "left")
        apart = F.aggregate(F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        out = s.cut(both.where(F.coalesce(apart * (q + p) <= (F.col("na") + F.col("nb")) * (q - p), F.lit(True))).select("a", "b"), "alike-pairs")
        s.drop(large)
        return out

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the written pairs (a, b) whose full sets meet the threshold. Of each set one text is read again."""
        s, share = self.s, self.share
        alike = self.alike(pairs)
        wanted = s.cut(self.wanted(alike), "wanted-nodes")

        def shingles(doc: np.ndarray, h: np.ndarray, n: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            return pa.RecordBatch.from_arrays([_binary(node), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))], names=["node", "shingles"])

        sets = self.texts_of(wanted, shingles, "node binary, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles"))
        # both sides of the pairs read the same shuffled sets
        both = alike.join(sets.alias("x"), F.col("a") == F.col("x.node")).select("a", "b", F.col("shingles").alias("sa"))
        both = both.join(sets.alias("y"), F.col("b") == F.col("y.node")).select("a", "b", "sa", F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        links = s.cut(both.where(common * (share[0] + share[1]) >= (F.size("sa") + F.size("sb")) * share[0]).select("a", "b"), "links")
        s.drop(wanted, *([alike] if alike is not pairs else []))
        return links

    def components(self) -> DataFrame:
        """(node, component) of the nodes that have links."""
        s = self.s
        labels, edges, tried = None, None, None
        for k in range(ROUNDS):
            pairs = self.led(labels, k)
            new = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
            found = self.verified(new)
            tried = pairs if tried is None else tried.unionByName(pairs)
            edges = found if edges is None else edges.unionByName(found)
            s.drop(labels)
            labels = components(edges, s)
            if k and found.isEmpty():
                break
        edges = edges.unionByName(self.verified(self.opened(labels, tried)))
        s.drop(labels)
        return components(edges, s)


def jaccard_components(docs: DataFrame, width: int = 4, share: tuple[int, int] = (85, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are runs of characters other than space, tab and line ends, A-Z in lower case; a set holds the distinct shingles
    of `width` words, or the whole sequence where it is shorter. Two documents link when share[1] * intersection >=
    share[0] * union; component_id is the smallest doc_id that links reach. A null text or one without words has no
    shingle and links with nothing; a row without an id has no component but may connect others; rows with the same id
    each get a result; extra columns are ignored; an empty table gives no rows. Shingles are told apart by 64-bit hashes, sets
    by 128-bit digests.
    """
    return _grouped(docs, width, share, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, width: int = 4, share: tuple[int, int] = (85, 100), id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """jaccard_components with `row`, a digest of the text, and `group`, one value for each component (null without words)."""
    ship(docs.sparkSession)
    s = scratch or Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    join = _Join(rows, width, share, s)
    join.index()
    labels = join.components()
    ids = join.nodes.select("node", "id")
    smallest = s.cut(labels.join(ids, "node").groupBy("component").agg(F.min("id").alias("smallest")), "component-ids")
    known = labels.join(smallest, "component").select("node", "smallest", "component")
    known = s.cut(ids.join(known, "node", "left").select("node", F.coalesce("smallest", "id").alias("smallest"), F.coalesce("component", "node").alias("group")), "node-ids")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    out = join.docs.join(known, "node", "left").select("doc_id", "row", "group", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))
    out = s.cut(out, "document-components")
    s.keep_only(out)
    return out


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents, columns unchanged, that are the first of their component, by id and then by a digest of the text.

    Rows that share an id are judged each by its own text. Documents without words, and rows without an id, stay. Of rows
    that repeat both id and text one stays. Most texts are kept where they are, by a bit table; only the others are joined.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    s = Scratch(docs.sparkSession)
    grouped = _grouped(docs, scratch=s, **options)
    found = grouped.where("component_id IS NOT NULL").select("doc_id", "row", "group")
    key = F.struct("doc_id", "row")
    first = s.cut(found.where("group IS NOT NULL").groupBy("group").agg(F.min(key).alias("first")), "component-firsts")
    told = found.join(first, "group", "left").groupBy("doc_id", "row").agg(F.max(F.coalesce(key != F.col("first"), F.lit(False))).alias("__gone"), F.count(F.lit(1)).alias("n"))
    told = told.where("__gone OR n > 1").select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "__gone", F.xxhash64("doc_id", "row").alias("key"))
    told = s.cut(told, "told-rows")
    s.drop(grouped, first)
    row, own = F.xxhash64(text_col), F.col(id_col).cast("long")
    sieved = sifted(docs, F.xxhash64(own, row), told.select("key"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    judged = sieved.where("__maybe").join(told.select("__id", "__row", "__gone"), (own == F.col("__id")) & (row == F.col("__row")), "left")
    single = judged.where("__gone IS NULL").select(*names)
    repeated = judged.where("NOT __gone").select(*names).dropDuplicates([id_col, text_col])
    return sieved.where("NOT __maybe").select(*names).unionByName(single).unionByName(repeated)
