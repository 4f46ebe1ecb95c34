"""Near-duplicate groups by an exact Jaccard join of word shingles.

Texts link when the Jaccard similarity of their sets of five-word shingles is
0.75 or more; the join is the rare-first prefix filter.  Every set is ordered
by how rare its shingles are, and two sets that link must share one in their
prefixes (the first |x| - ceil(t|x|) + 1).  Rarity is counted over all texts in
a table of a fixed number of slots: any order that all sets share is exact, and
the slots' size is bounded at every input size.

1. One pass makes each text's set digest and adds up the slots.  Texts with one
   set are one class from here on, so copies never meet each other.
2. A second pass sends each class's prefix n-grams (once a chunk of texts), with
   set size and position, as packed byte planes; buckets drop n-grams that one
   class alone has.  N-grams of very full slots travel as rows instead, so that a
   shuffle join can split them.
3. Star round: in each n-gram's list every class meets the class that has the n-gram at its lowest
   position (length and positional filters): of a family of edited copies, the one with the fewest n-grams of its own.
   As a pair may meet its star at another than their first common n-gram, the positional bound counts all n-grams before it as common.
   Remaining round: where a list still holds several components, the members
   outside its main one meet all members of other components, in blocks of sets.  There length
   and positional filters (there with the first common n-gram, which is among the lists) apply before a pair is emitted.  Each pair of either round is
   verified once, with a suffix filter ahead of the full intersection.  A pair
   that the second round leaves out lies in one component already, so no
   component is missed and no group is expanded into all its pairs.

Defined results: a text of fewer than five words, but not none, has its whole
sequence as its one shingle; a null text, or one without words, has an empty set
and is linked with nothing.  Rows may repeat: equal sets share a group.  A null
id takes part but names a group only if all its members' ids are null.  Ids are whole
numbers; others are refused.  Other columns are passed through unless their names clash with added ones.

A class is named by 64 bits of its set's MD5; the next 64 bits tell classes apart whose first
bits agree, and these few are named by those instead.  Shingles are equal if 64 keyed random bits are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.components import components
from docloom.llm.store import Table, by_bucket, extended, integral, scratch, shuffle_partitions

SHINGLE = 5
#: Similarity as a fraction: intersection * DEN >= union * NUM.
NUM, DEN = 3, 4
#: Slots of the rarity table, 4 bytes each: what a broadcast of it holds at the most.
SLOT_BITS = 20
#: An n-gram whose slot holds this much more than slots do on average travels as rows.
FULL_SLOT = 50_000
#: Buckets of prefix n-grams: so many for each shuffle partition, and more where one would hold more bytes than this.
BUCKETS_A_PARTITION = 2
BUCKET_BYTES = 64_000_000
_POSTING_BYTES = 14
#: Prefix n-grams that a chunk holds before it is sent.
CHUNK_POSTINGS = 1_000_000


def _set_ids(text: np.ndarray, h: np.ndarray, n: int, clashing: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each text's set, its name, and the next 64 bits of its digest, which are the name where first ones clash."""
    size = np.bincount(text, minlength=n)
    off = np.r_[0, np.cumsum(size)]
    raw = h.tobytes()
    both = np.frombuffer(b"".join(hashlib.md5(raw[8 * a : 8 * b]).digest() for a, b in zip(off, off[1:], strict=False)), "<i8").reshape(-1, 2)
    ids, more = both[:, 0].copy(), both[:, 1].copy()
    if clashing is not None and len(clashing):
        ids = np.where(np.isin(ids, clashing), more, ids)
    return size, ids, more


def _describe(shingle: int, rule: k.WordRule):
    schema = pa.schema([("n", pa.int64()), ("sid", pa.int64()), ("more", pa.int64()), ("doc", pa.int64()), ("slots", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, np.int64)
        seen = False
        for batch in batches:
            for a, b in k.slices(batch.column(1)):
                text, h = k.shingle_sets(k.words(batch.column(1).slice(a, b - a), rule), shingle)
                size, ids, more = _set_ids(text, h, b - a)
                slots += np.bincount((h >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(slots))
                seen = True
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(ids), pa.array(more), batch.column(0).slice(a, b - a).cast(pa.int64()), pa.nulls(b - a, pa.binary())], schema=schema)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.nulls(1, pa.int64()), k.binary_column([_slot_bytes(slots)])], schema=schema)

    return run


def _slot_bytes(slots: np.ndarray) -> bytes:
    return np.minimum(slots, 2**32 - 1).astype("<u4").tobytes()


def _add_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(1 << SLOT_BITS, np.int64), False
    for batch in batches:
        for x in batch.column(0):
            total += np.frombuffer(x.as_buffer(), "<u4")
            seen = True
    if seen:
        yield pa.RecordBatch.from_arrays([k.binary_column([_slot_bytes(total)])], names=["slots"])


def _rarity(described: Table) -> np.ndarray:
    """The slots' sums: added up in a tree, a few tables at a time; one table of a fixed size reaches the driver."""
    parts = Table(described.df.filter("n = -1").select("slots"), "slots")
    while (m := parts.df.count()) > 1:
        step = Table(parts.df.repartition(-(-m // 16)).mapInArrow(_add_slots, "slots binary"), "slots")
        parts.drop()
        parts = step
    row = parts.df.first()
    parts.drop()
    return np.frombuffer(bytes(row.slots), "<u4") if row else np.zeros(1 << SLOT_BITS, "<u4")


def _prefix(size: np.ndarray) -> np.ndarray:
    return size - (NUM * size + DEN - 1) // DEN + 1


def _postings(shingle: int, rule: k.WordRule, shared, buckets: int, clashing: np.ndarray):
    """Prefix n-grams of each distinct set of a chunk: packed by bucket, or as rows where a slot is very full."""
    schema = pa.schema([("bucket", pa.int64()), ("token", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("pos", pa.int64()), ("blob", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value.astype(np.int64)
        full = FULL_SLOT + int(rank.mean())
        parts: list[tuple] = []
        held = 0

        def send():
            token, sid, n, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((sid, token))
            token, sid, n, pos = token[order], sid[order], n[order], pos[order]
            new = np.ones(len(token), bool)  # copies in one chunk send one posting
            new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
            token, sid, n, pos = token[new], sid[new], n[new], pos[new]
            hot = rank[(token >> np.uint64(64 - SLOT_BITS)).astype(np.int64)] > full
            if hot.any():
                m = int(hot.sum())
                yield pa.RecordBatch.from_arrays([pa.array(-1 - (k.mix(token[hot] ^ sid[hot].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)), pa.array(k.as_signed(token[hot])), pa.array(sid[hot]), pa.array(n[hot]), pa.array(pos[hot]), pa.nulls(m, schema.types[5])], schema=schema)
            token, sid, n, pos = token[~hot], sid[~hot], n[~hot], pos[~hot]
            width = np.uint64((1 << 64) // buckets + 1)
            edge = np.searchsorted(token, np.arange(1, buckets, dtype=np.uint64) * width)
            rows = [(b, [k.delta_planes(token[x:y]), sid[x:y].tobytes(), k.to_planes(n[x:y]), k.to_planes(pos[x:y])]) for b, (x, y) in enumerate(zip(np.r_[0, edge], np.r_[edge, len(token)], strict=True)) if x < y]
            for at in range(0, len(rows), 64):
                some = rows[at : at + 64]
                z = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), z, z, z, z, pa.array([r[1] for r in some], schema.types[5])], schema=schema)

        for batch in batches:
            for a, b in k.slices(batch.column(1)):
                text, h = k.shingle_sets(k.words(batch.column(1).slice(a, b - a), rule), shingle)
                size, ids, _ = _set_ids(text, h, b - a, clashing)
                off = np.r_[0, np.cumsum(size)]
                rare = rank[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                for x, y in zip(off.tolist(), off[1:].tolist(), strict=False):
                    h[x:y] = h[x:y][np.argsort(rare[x:y], kind="stable")]  # ties stay in order of hash
                pos = np.arange(len(h)) - off[text]
                m = pos < _prefix(size)[text]
                parts.append((h[m], ids[text[m]], size[text[m]], pos[m]))
                held += int(m.sum())
                if held >= CHUNK_POSTINGS:
                    yield from send()
                    parts, held = [], 0
        if held:
            yield from send()

    return run


def _shared_only(key: tuple, group: pa.Table) -> pa.Table:
    """Of one bucket: the postings of n-grams that several sets have; rows of very full slots pass, each once."""
    if key[0].as_py() < 0:
        return group.select(["token", "sid", "n", "pos"]).group_by(["token", "sid", "n", "pos"]).aggregate([])
    blobs = group["blob"].to_pylist()
    token = np.concatenate([k.from_delta_planes(x[0]) for x in blobs])
    sid = np.concatenate([np.frombuffer(x[1], np.int64) for x in blobs])
    n, pos = (np.concatenate([k.from_planes(x[i]) for x in blobs]).astype(np.int64) for i in (2, 3))
    order = np.argsort(token)
    t = token[order]
    same = np.zeros(len(t) + 1, bool)
    same[1:-1] = t[1:] == t[:-1]
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((sid[order], token[order]))]
    token, sid, n, pos = token[order], sid[order], n[order], pos[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid, n, pos = token[new], sid[new], n[new], pos[new]
    same = np.zeros(len(token) + 1, bool)
    same[1:-1] = token[1:] == token[:-1]
    m = same[1:] | same[:-1]
    return pa.table({"token": k.as_signed(token[m]), "sid": sid[m], "n": n[m], "pos": pos[m]})


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b")).distinct()


#: Sets of one family, and rows of theirs, that a task pairs with each other; a larger family is cut into blocks.
BLOCK_SETS = 500
BLOCK_ROWS = 250_000
_STEP = 1_000_000


def _meet(left: pa.Table, right: pa.Table) -> pa.Table:
    """Candidate pairs of a unit, each once: members outside their list's main component, and members of other components."""
    m, a = ({c: t[c].to_numpy() for c in ("token", "sid", "n", "pos", "root", "main")} for t in (left, right))
    order = np.argsort(a["token"], kind="stable")
    a = {c: v[order] for c, v in a.items()}
    lo, hi = np.searchsorted(a["token"], m["token"]), np.searchsorted(a["token"], m["token"], side="right")
    sids = np.unique(np.r_[m["sid"], a["sid"]])
    im, ia = np.searchsorted(sids, m["sid"]), np.searchsorted(sids, a["sid"])
    total = np.cumsum(hi - lo)
    found = [np.empty(0, np.int64)]
    at = 0
    while at < len(lo):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _STEP, side="right")))
        many = (hi - lo)[at:to]
        x = np.repeat(np.arange(at, to), many)
        y = np.repeat(lo[at:to], many) + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
        nx, ny = m["n"][x], a["n"][y]
        ok = (m["root"][x] != a["root"][y]) & ((a["root"][y] == a["main"][y]) | (m["sid"][x] < a["sid"][y]))
        ok &= (DEN * np.minimum(nx, ny) >= NUM * np.maximum(nx, ny)) & (np.minimum(nx - m["pos"][x], ny - a["pos"][y]) >= -(-NUM * (nx + ny) // (NUM + DEN)))
        x, y = im[x[ok]], ia[y[ok]]
        found.append(np.unique(np.minimum(x, y) * len(sids) + np.maximum(x, y)))
        at = to
    code = np.unique(np.concatenate(found))
    return pa.table({"a": sids[code // max(1, len(sids))], "b": sids[code % max(1, len(sids))]})


def _across(left: Table, buckets: int) -> DataFrame:
    """Candidate pairs across components.  Lists with one main component are a family: its n-grams meet in one place, so a
    pair is emitted once and not for each n-gram it shares.  Small families share buckets, ``buckets`` at least and more where one would
    hold more rows than a block; a large one is cut into blocks of sets."""
    own = left.df.groupBy("main", "sid").agg(F.max(F.col("root") != F.col("main")).alias("out"), F.count("*").alias("rows"))
    family = own.groupBy("main").agg(F.count("*").alias("n_all"), F.count_if("out").alias("n_out"), F.sum("rows").alias("r_all"), F.sum(F.when(F.col("out"), F.col("rows")).otherwise(0)).alias("r_out"))

    def blocks(which: str) -> Column:
        return F.ceil(F.greatest(F.col(f"n_{which}") / BLOCK_SETS, F.col(f"r_{which}") / BLOCK_ROWS)).cast("long").alias(f"{which}_blocks")

    family = Table(family.select("main", blocks("out"), blocks("all")), "families")
    buckets = max(buckets, -(-left.df.count() // BLOCK_ROWS))
    rows, again = (left.df.join(family.side(), "main") for _ in range(2))
    small = (F.col("out_blocks") <= 1) & (F.col("all_blocks") <= 1)
    unit = F.when(small, F.pmod(F.xxhash64("main"), F.lit(buckets))).otherwise(F.col("main"))
    block = F.xxhash64("sid")
    cols = ["token", "sid", "n", "pos", "root", "main"]
    out = rows.filter("root != main").select(*cols, unit.alias("unit"), F.pmod(block, F.greatest("out_blocks", F.lit(1))).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("j"))
    every = again.filter("out_blocks > 0").select(*cols, unit.alias("unit"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_blocks") - 1)).alias("i"), F.pmod(block, F.col("all_blocks")).alias("j"))
    return out.groupBy("unit", "i", "j").cogroup(every.groupBy("unit", "i", "j")).applyInArrow(_meet, "a long, b long")


def _need(x: int, y: int) -> int:
    return -(-NUM * (x + y) // (NUM + DEN))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two ascending sets link: a suffix filter halves both at a pivot and bounds the overlap, then the overlap is counted."""
    need = _need(len(x), len(y))
    pivots = y[[len(y) // 4, len(y) // 2, 3 * len(y) // 4]]
    cx, cy = np.searchsorted(x, pivots), np.searchsorted(y, pivots)
    if np.minimum(np.diff(np.r_[0, cx, len(x)]), np.diff(np.r_[0, cy, len(y)])).sum() < need:
        return False
    at = np.searchsorted(x, y)
    return int((x[np.minimum(at, len(x) - 1)] == y).sum()) >= need


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        x, y = batch.column(2), batch.column(3)
        ok = [_linked(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)) for i in range(len(a))]
        m = np.array(ok, bool)
        yield pa.RecordBatch.from_arrays([pa.array(a[m]), pa.array(b[m])], names=["u", "v"])


#: Parts by hash that a set is counted in; the sum of the smaller counts bounds an overlap.
PARTS = 256


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(a):
            continue
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, PARTS).astype(np.int64) for i in (2, 3))
        m = np.minimum(x, y).sum(1) >= -(-NUM * (x.sum(1) + y.sum(1)) // (NUM + DEN))
        yield pa.RecordBatch.from_arrays([pa.array(a[m]), pa.array(b[m])], names=["a", "b"])


def _sets(shingle: int, rule: k.WordRule, counts: bool, clashing: np.ndarray):
    """Sets of the wanted texts, or how many of their shingles each part holds."""

    def value(h: np.ndarray) -> bytes:
        return np.bincount((h & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS).astype("<u4").tobytes() if counts else h.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in k.slices(batch.column(1)):
                text, h = k.shingle_sets(k.words(batch.column(1).slice(a, b - a), rule), shingle)
                size, ids, _ = _set_ids(text, h, b - a, clashing)
                off = np.r_[0, np.cumsum(size)]
                # A row is wanted for its own set: where an id has several texts, the others are left out.
                want = batch.column(0).slice(a, b - a).to_numpy()
                rows = np.flatnonzero(ids == want)
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), k.binary_column([value(h[off[r] : off[r + 1]]) for r in rows])], names=["sid", "set"])

    return run


class _Sets:
    """What every pass over the texts shares: the rows, how sets are made and named, and one text of each class."""

    def __init__(self, rows: DataFrame, shingle: int, rule: k.WordRule):
        self.rows, self.shingle, self.rule = rows, shingle, rule
        described = Table(rows.mapInArrow(_describe(shingle, rule), "n long, sid long, more long, doc long, slots binary"), "described")
        clash = described.df.filter("n > 0").groupBy("sid").agg(F.min("more").alias("a"), F.max("more").alias("b")).filter("a <> b").select("sid").collect()
        self.clashing = np.array(sorted(r.sid for r in clash), np.int64)  # of n classes, n * n / 2**65 are to be expected
        sid = F.when(F.col("sid").isin(self.clashing.tolist()), F.col("more")).otherwise(F.col("sid")) if clash else F.col("sid")
        self.described = described
        self.named = described.df.filter("n >= 0").select("n", sid.alias("sid"), "doc")
        self.classes = Table(self.named.filter("n > 0").groupBy("sid").agg(F.min("doc").alias("doc")), "classes")

    def linked(self, pairs: Table) -> Table:
        """The pairs that link.  Counts by part (a kilobyte a set) leave out most pairs that do not; sets travel for the rest."""
        with scratch():
            likely = Table(self._with_sets(pairs, counts=True).mapInArrow(_possible, "a long, b long"), "likely")
            return Table(self._with_sets(likely, counts=False).mapInArrow(_verify, "u long, v long"), "links").keep()

    def _with_sets(self, pairs: Table, counts: bool) -> DataFrame:
        """``a``, ``b`` and their sets, made again from one text of each class.  Rows of repeated ids repeat pairs, which does no harm."""
        wanted = pairs.df.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(self.classes.df, "sid").select("sid", "doc")
        wanted = Table(wanted, "wanted")
        texts = self.rows.join(wanted.side().withColumnRenamed("doc", "own"), F.col("doc").eqNullSafe(F.col("own"))).select("sid", "text")
        sets = Table(texts.mapInArrow(_sets(self.shingle, self.rule, counts, self.clashing), "sid long, set binary"), "sets")
        x, y = (sets.df.select(F.col("sid").alias(c), F.col("set").alias(f"{c}_set")) for c in "ab")
        return pairs.df.hint("merge").join(x, "a").join(y, "b").select("a", "b", "a_set", "b_set")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, rule: k.WordRule = k.SPACED_LOWER) -> DataFrame:
    """For each row of ``docs``: ``id``, ``sid`` (its set's name; null if empty), ``root`` (the group's smallest name), ``n_shingles``, ``component_id`` (smallest id of its group)."""
    spark = docs.sparkSession
    rows = docs.select(integral(docs, id_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    with scratch():
        sets = _Sets(rows, shingle, rule if rule.key else k.keyed(rule))
        links = _links(spark, sets)
        last = components(links.df)
        named = sets.classes.df.join(last.side(), F.col("sid") == F.col("node"), "left").select("sid", "doc", F.coalesce("root", "sid").alias("root"))
        least = Table(named.groupBy("root").agg(F.min("doc").alias("component_id"), F.count("*").alias("many")).filter("many > 1").drop("many"), "least")
        groups = Table(named.join(least.side(), "root", "left").select("sid", "root", F.coalesce("component_id", "doc").alias("component_id")), "groups").keep()
        sets.described.keep()
    out = sets.named.select(F.col("doc").alias("id"), F.when(F.col("n") > 0, F.col("sid")).alias("sid"), F.col("n").alias("n_shingles"))
    return out.join(groups.side(), "sid", "left").select("id", "sid", "root", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def _links(spark: SparkSession, sets: _Sets) -> Table:
    """Verified pairs of classes that connect all that link."""
    rank = spark.sparkContext.broadcast(_rarity(sets.described))
    total = sets.named.agg(F.sum(F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1)).first()[0] or 0
    full = -(-total * _POSTING_BYTES // BUCKET_BYTES)
    buckets = max(BUCKETS_A_PARTITION * shuffle_partitions(spark), full)
    sent = sets.rows.filter(F.length("text") > 0).mapInArrow(_postings(sets.shingle, sets.rule, rank, buckets, sets.clashing), "bucket long, token long, sid long, n long, pos long, blob array<binary>")
    posts = Table(by_bucket(sent, full).groupBy("bucket").applyInArrow(_shared_only, "token long, sid long, n long, pos long"), "postings")
    rank.unpersist()

    hubs = Table(posts.df.groupBy("token").agg(F.min(F.struct("pos", "sid", "n")).alias("hub"), F.count("*").alias("many")).filter("many > 1").select("token", "hub.*"), "hubs")
    lengths = f"a.sid != b.sid and {DEN} * least(a.n, b.n) >= {NUM} * greatest(a.n, b.n)"
    places = f"{NUM + DEN} * (least(a.pos, b.pos) + least(a.n - a.pos, b.n - b.pos)) >= {NUM} * (a.n + b.n)"
    star = Table(_pairs(posts.df.alias("a").join(hubs.df.alias("b"), "token").filter(f"{lengths} and {places}")), "pairs")
    links = sets.linked(star)
    first = components(links.df)

    # Where a list holds several components still: its members outside the main one, against all of other components.
    label = posts.df.join(first.side().select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    label = Table(label, "labelled")
    posts.drop()
    split = label.df.groupBy("token", "root").agg(F.count("*").alias("many")).groupBy("token").agg(F.max(F.struct("many", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1")
    split = Table(split.select("token", F.col("main.root").alias("main")), "split")
    left = Table(label.df.join(split.side(), "token"), "left")
    label.drop()
    cross = _across(left, 4 * shuffle_partitions(spark))
    rest = Table(cross.distinct().join(star.df, ["a", "b"], "left_anti"), "pairs")
    more = sets.linked(rest)
    # What the first round has found enters as its forest, which is shorter than its links.
    return Table(first.df.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more.df), "links")


def _add_sid(at: int, shingle: int, rule: k.WordRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in k.slices(batch.column(at)):
                part = batch.slice(a, b - a)
                size, ids, more = _set_ids(*k.shingle_sets(k.words(part.column(at), rule), shingle), b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, mask=size == 0), pa.array(more, mask=size == 0)], names=[*part.schema.names, "__docloom_sid", "__docloom_more"])

    return run


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, rule: k.WordRule = k.SPACED_LOWER) -> DataFrame:
    """``docs`` without near copies: of each group the document whose id names it stays; documents with empty sets all stay.

    Of rows that share the group's id, the one whose text sorts first stays.
    """
    rule = rule if rule.key else k.keyed(rule)
    groups = Table(near_duplicate_groups(docs, id_col, text_col, shingle, rule), "groups")
    stays = F.col("sid").isNull() | F.col("id").eqNullSafe(F.col("component_id"))
    # Fewer rows go than stay; their ids, some 60 bytes each in a hash table, are kept from moving the texts as long as they may.
    gone = Table(groups.df.filter(~stays).select(F.col("id").alias("__docloom_id")).distinct(), "gone")
    several = Table(groups.df.groupBy(F.col("id").alias("__docloom_id")).agg(F.count("*").alias("many")).filter("many > 1").select("__docloom_id"), "several")
    same = integral(docs, id_col).eqNullSafe(F.col("__docloom_id"))
    if several.df.isEmpty():
        groups.drop()
        return docs.join(gone.side(max_rows=400_000), same, "left_anti")
    own = groups.df.filter(stays).select(F.col("id").alias("__docloom_id"), F.col("sid").alias("__docloom_own"), F.col("root").alias("__docloom_root")).distinct()
    stay = Table(own.alias("o").join(several.df.alias("s"), F.col("o.__docloom_id").eqNullSafe(F.col("s.__docloom_id")), "left_semi"), "stay")
    groups.drop()
    rest = docs.join(several.side(), same, "left_semi")
    named = rest.mapInArrow(_add_sid(docs.columns.index(text_col), shingle, rule), extended(docs, docs.columns, __docloom_sid=T.LongType(), __docloom_more=T.LongType()))
    mine = F.col("__docloom_own").eqNullSafe(F.col("__docloom_sid")) | F.col("__docloom_own").eqNullSafe(F.col("__docloom_more"))
    kept = named.join(stay.df, same & mine)
    # Of the rows of an id and group one is kept; rows without words are kept each.
    first = Window.partitionBy("__docloom_id", "__docloom_root").orderBy(F.col(f"`{text_col}`").asc_nulls_last())
    kept = kept.withColumn("__docloom_n", F.row_number().over(first)).filter("__docloom_n = 1 or __docloom_sid is null").select(*[f"`{c}`" for c in docs.columns])
    one = docs.join(several.side(), same, "left_anti").join(gone.side(max_rows=400_000), same, "left_anti")
    return one.unionByName(kept)
