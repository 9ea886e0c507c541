"""Near-duplicate classes by one-permutation MinHash, banded buckets and star edges.

1. One pass turns each text into its set of word shingles and a one-permutation
   sketch: the hash range is cut into bins, each bin keeps its least hash, and empty
   bins copy another bin found by a universal hash (optimal densification,
   Shrivastava 2017). Bands of the sketch are the bucket keys.
2. Documents with equal sets are one node, whatever their ids; only nodes go on.
3. In every bucket each member is paired with the least member only, so a bucket of m
   members gives m - 1 candidates. Candidates are confirmed on the full sets.
4. Links of two members that the star did not join are found exactly: the sets of
   buckets whose members still lie in several components are compared where they share
   one of their rarest shingles (prefix and position filter: Chaudhuri et al. 2006,
   Xiao et al. 2008), in blocks of bounded size.
5. Components: in each round every node goes over to its neighbour of the least hash,
   which is another order each time, and the links are contracted. A bounded number of
   links that is left is joined in one task. A class is named by its least id.

Bands are chosen so that a pair at the threshold is missed by all with a probability
under 2e-6 (72 bands of 6 bins: (1 - 0.75**6)**72 = 7e-7).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_among, hot_keys, join_lookup, materialise, mix64

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
CASE = bytes.maketrans(UPPER, LOWER)
#: Blocks of an exact comparison: rows, and shingles of their sets together; and shingles for one task.
BLOCK, BLOCK_SHINGLES, UNIT_SHINGLES = 512, 1_000_000, 4_000_000
#: So many links, both ways, are joined in one task.
FINISH = 400_000
#: What a row of a comparison is: of a whole small group, or of one side of a block.
WHOLE, OUTSIDE, ALL = 0, 1, 2


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles.

    A-Z are lower-cased; words are runs of other characters than space and
    U+0009..U+000D. Fewer than k words: the whole sequence is one shingle. Null or no
    word: empty.
    """
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").translate(CASE).split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    size = min(k, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_factors(size)):
        total += h[i : i + n] * factor
    return np.unique(mix64(total))


@lru_cache
def _factors(size: int) -> np.ndarray:
    """Odd multipliers for the words of a shingle."""
    return mix64(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(1000 * size)) | np.uint64(1)


class Sketch:
    """One-permutation sketch with optimal densification, cut into bands."""

    #: Attempts that are looked up at once, one stretch after another.
    STRETCHES = ((0, 12), (12, 48), (48, 256))

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        step = (1 << 64) // self.bins
        self.edges = np.array([i * step for i in range(self.bins)], np.uint64)
        self.weights = mix64(np.arange(1, self.bins + 1, dtype=np.uint64)) | np.uint64(1)
        self.donors = np.array([self._donor(np.arange(self.bins), t) for t in range(self.STRETCHES[-1][1])])

    def _donor(self, empty: np.ndarray, attempt: int) -> np.ndarray:
        """The bin that an empty bin copies at an attempt: a universal hash of both."""
        return (mix64((empty + attempt * self.bins).astype(np.uint64)) % np.uint64(self.bins)).astype(np.int64)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        """One hash for every bin; hashes: sorted, distinct, at least one."""
        at = np.searchsorted(hashes, self.edges)
        full = np.append(at[1:], len(hashes)) > at
        out = hashes[np.minimum(at, len(hashes) - 1)]
        if full.all():
            return out
        known = np.flatnonzero(full)
        if len(known) == 1:
            return np.full(self.bins, out[known[0]])
        empty = np.flatnonzero(~full)
        for low, high in self.STRETCHES:
            donors = self.donors[low:high, empty]
            works = full[donors]
            first, all_of = works.argmax(axis=0), np.arange(len(empty))
            found = works[first, all_of]
            out[empty[found]] = out[donors[first, all_of][found]]
            empty = empty[~found]
            if not len(empty):
                return out
        attempt = self.STRETCHES[-1][1]
        while len(empty):
            donor = self._donor(empty, attempt)
            found = full[donor]
            out[empty[found]] = out[donor[found]]
            empty, attempt = empty[~found], attempt + 1
        return out

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One signed 64-bit bucket key for every band."""
        with np.errstate(over="ignore"):
            weighed = self.values(hashes) * self.weights
            return mix64(weighed.reshape(self.bands, self.rows).sum(axis=1, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, set_key (hash of the whole set), bands (array<long>; empty for no words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(bands, rows)
        for batch in batches:
            n = batch.num_rows
            sizes, set_keys = np.zeros(n, np.int64), []
            keys = np.zeros((n, bands), np.int64)
            # One text and its set at a time: a batch may hold many long ones.
            for i, text in enumerate(batch.column("text")):
                found = shingle_set(text.as_py(), k)
                sizes[i] = len(found)
                set_keys.append(blake2b(found.tobytes(), digest_size=16).hexdigest())
                if len(found):
                    keys[i] = sketch.keys(found)
            full = sizes > 0
            ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes), pa.array(set_keys, pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].ravel()))],
                names=["doc_id", "text_key", "n_shingles", "set_key", "bands"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(sign, "doc_id long, text_key long, n_shingles long, set_key string, bands array<long>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int, broadcast_ids: int) -> DataFrame:
    """node, hashes (binary, sorted uint64) of the wanted sets (node, doc_id, text_key).

    Up to broadcast_ids keys are sent to the texts; more, and the texts are shuffled to
    them.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch.node, "hashes": [shingle_set(t, k).tobytes() for t in batch.text]})

    few = wanted.limit(broadcast_ids + 1).count() <= broadcast_ids
    found = _texts(docs, id_col, text_col).join(F.broadcast(wanted) if few else wanted, ["doc_id", "text_key"]).select("node", "text")
    # A row may be there more than once.
    return found.mapInPandas(encode, "node long, hashes binary").groupBy("node").agg(F.min("hashes").alias("hashes"))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b|, for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked on their full sets."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.ha, batch.hb, strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    # A hub has as many pairs as its bucket has members, and they take its set along: by members first.
    whole = join_lookup(pairs.join(right, "b"), left, "a", hot_keys(pairs, "a"))
    return whole.select("a", "b", "ha", "hb").mapInPandas(check, "a long, b long")


def _links_between(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> set[tuple[int, int]]:
    """Linked pairs of different components, on full sets.

    Hashes are numbered once; each row of left marks its own, and all rows of right
    count theirs among the marked ones together.
    """
    sets = [np.frombuffer(x, np.uint64) for x in (*left.hashes, *right.hashes)]
    sizes = np.array([len(x) for x in sets])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n = len(left)
    other, from_other = numbers[starts[n] :], starts[n:] - starts[n]
    ids, comps = right.node.to_numpy(), right.comp.to_numpy()
    out: set[tuple[int, int]] = set()
    marks = np.zeros(numbers.max() + 1, bool)
    for i, (node, comp) in enumerate(zip(left.node, left.comp, strict=True)):
        mine = numbers[starts[i] : starts[i] + sizes[i]]
        marks[mine] = True
        shared = np.add.reduceat(marks[other], from_other, dtype=np.int64)
        marks[mine] = False
        linked = (100 * shared >= percent * (sizes[i] + sizes[n:] - shared)) & (comps != comp)
        out.update((int(node), int(x)) for x in ids[linked])
    return out


def _prefixes(sets: DataFrame, percent: int, cells: int) -> DataFrame:
    """token, node, comp, n, place: the rarest shingles of every set, enough for a link to show.

    Two linked sets share one of the first n - ceil(percent * n / 100) + 1 shingles of
    each, whatever the order, if it is the same for all sets. Rare ones come first, by
    counts in a table of hashed cells, so frequent shingles are seldom reached.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(cells, np.int64)
        for batch in batches:
            h = np.frombuffer(b"".join(batch.hashes), np.uint64)
            sums += np.bincount((h % np.uint64(cells)).astype(np.int64), minlength=cells)
        full = np.flatnonzero(sums)
        yield pd.DataFrame({"cell": full, "n": sums[full]})

    # At most `cells` rows reach the driver.
    table = sets.select("hashes").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    weight = np.zeros(cells, np.int64)
    weight[table["cell"].to_numpy()] = table["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(weight)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            sizes = np.array([len(x) // 8 for x in batch.hashes], np.int64)
            taken = sizes + percent * sizes // -100 + 1
            for x, k in zip(batch.hashes, taken, strict=True):
                h = np.frombuffer(x, np.uint64)
                # h is sorted, so a stable sort by weight is one order for all sets.
                order = np.argsort(shared.value[(h % np.uint64(cells)).astype(np.int64)], kind="stable")[:k]
                tokens.append(h[order].view(np.int64))
                places.append(np.arange(k))
            each = lambda values: np.repeat(values, taken)
            yield pd.DataFrame({"token": np.concatenate(tokens), "node": each(batch.node.to_numpy()), "comp": each(batch.comp.to_numpy()), "n": each(sizes), "place": np.concatenate(places)})

    return sets.select("node", "comp", "hashes").mapInPandas(first, "token long, node long, comp long, n long, place long")


def _rest(crowd: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, cells: int = 1 << 20) -> DataFrame:
    """All links across components among the sets of buckets that still hold several.

    Sets that share one of their rarest shingles are compared: those outside a
    shingle's largest component against all that have it. A shingle so far back that
    too few are left behind it for a link with any set of its group is left out, and of
    shingles that the same sets have, one stands for all. Both sides are dealt out in
    blocks of bounded rows and bytes and a task sees two blocks at a time, never a
    group. Only confirmed links come out.
    """

    def links(members: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out: set[tuple[int, int]] = set()
        members["hashes"] = members.node.map(dict(zip(given.member, given.hashes, strict=True)))
        for _, unit in members.groupby(["token", "i", "j"], sort=False):
            left, right = unit[unit.side == OUTSIDE], unit[unit.side == ALL]
            if (unit.side == WHOLE).any():
                top = unit.comp.mode()[0]
                left, right = unit[unit.comp != top], unit
            if len(left) and len(right):
                out |= _links_between(left, right, percent)
        return pd.DataFrame(sorted(out), columns=["a", "b"], dtype="int64")

    labelled = materialise(crowd.join(labels, "node"))
    several = labelled.groupBy("band", "bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("band", "bucket")
    open_sets = materialise(sets.join(join_lookup(labelled, several, ["band", "bucket"], hot_keys(labelled, ["band", "bucket"])).select("node", "comp").distinct(), "node"))
    found = materialise(_prefixes(open_sets, percent, cells))
    groups = found.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least")).filter("low <> high")
    # The smallest set of the group that is large enough to be linked asks for the fewest shared shingles.
    smallest = F.greatest("least", F.expr(f"(n * {percent} + 99) div 100"))
    asked = (F.col("n") + F.col("smallest")) * percent + (99 + percent)
    many = hot_keys(found, "token")
    placed = join_lookup(found, groups.select("token", "least"), "token", many).withColumn("smallest", smallest)
    placed = materialise(placed.filter((F.col("n") - F.col("place")) >= F.floor(asked / (100 + percent))).select("token", "node", "comp", "n"))
    # Texts that share a passage share many shingles; those with the same members are one group.
    members = [F.count("*"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))]
    alike = placed.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *[c.alias(f"mark_{i}") for i, c in enumerate(members)]).filter("low <> high")
    placed = materialise(join_lookup(placed, alike.groupBy("mark_0", "mark_1", "mark_2").agg(F.min("token").alias("token")).select("token"), "token", many))
    by_comp = placed.groupBy("token", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("weight"))
    blocks = lambda rows, weight: F.ceil(F.greatest(rows / BLOCK, weight / BLOCK_SHINGLES)).cast("int")
    open_groups = (
        by_comp.groupBy("token")
        .agg(F.sum("k").alias("m"), F.sum("weight").alias("weight"), F.max(F.struct("k", "comp", "weight")).alias("top"), F.count("*").alias("comps"))
        .filter("comps > 1")
        .select("token", F.col("top.comp").alias("top"), blocks(F.col("m"), F.col("weight")).alias("js"), blocks(F.col("m") - F.col("top.k"), F.col("weight") - F.col("top.weight")).alias("is"))
    )
    dealt = materialise(join_lookup(placed, open_groups.join(placed.groupBy("token").agg(F.min("comp").alias("family")), "token"), "token", many))
    mark = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "token", "i", "j", "side", "node", "comp", "n"]
    one = (F.col("is") == 1) & (F.col("js") == 1)
    # Small groups go together by their least component, so that a set goes once to all groups that it is in.
    families = dealt.filter(one).select("family", "node", "n").distinct().groupBy("family").agg(F.ceil(F.sum("n") / UNIT_SHINGLES).alias("parts"))
    whole = dealt.filter(one).join(families, "family").withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(WHOLE), "key": F.xxhash64("family", F.pmod(F.xxhash64("token"), F.col("parts")))})
    large = dealt.filter(~one)
    outside = large.filter("comp <> top").withColumns({"i": F.pmod(mark, F.col("is")).cast("int"), "side": F.lit(OUTSIDE)}).withColumn("j", every("js"))
    inside = large.withColumns({"j": F.pmod(mark, F.col("js")).cast("int"), "side": F.lit(ALL)}).withColumn("i", every("is"))
    blocks_of = outside.unionByName(inside).withColumn("key", F.xxhash64("token", "i", "j"))
    both = materialise(whole.select(columns).unionByName(blocks_of.select(columns)))
    sent = both.select("key", "node", "n").distinct()
    tasks = 1 + (sent.agg(F.sum(F.col("n") + 64)).first()[0] or 0) // UNIT_SHINGLES
    unit = F.pmod("key", F.lit(tasks)).alias("unit")
    member = F.col("node").alias("member")
    given = both.select(unit, member).distinct().join(open_sets.select(member, "hashes"), "member").groupBy("unit")
    return both.select(unit, "token", "i", "j", "side", "node", "comp").groupBy("unit").cogroup(given).applyInPandas(links, "a long, b long").distinct()


def _joined(links: DataFrame) -> DataFrame:
    """node, parent of all nodes of a bounded number of links (a, b): the root of a union-find in one task."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(list(map(find, nodes)), pa.int64())], names=["node", "parent"])

    return links.filter("a < b").repartition(1).mapInArrow(join, "node long, parent long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, comp of all nodes: one node of those reachable over links (a, b), the same for all of them; alone: itself.

    Each round every node goes over to that of its neighbours and itself which has the
    least hash, and the links are contracted, so that those inside a component vanish.
    The hash is another one each round, so whatever the order of the nodes about half of
    a path's go in each. Once FINISH links or fewer are left, one task joins them. Then
    the rounds are put together from the last on. Every step is a written table; nodes
    with many links are dealt out.
    """
    left = materialise(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    rounds: list[DataFrame] = []
    while (count := left.count()) > FINISH:
        rank = lambda c, k=len(rounds): F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("to"))
        parent = materialise(left.groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a")))["to"].alias("parent")))
        rounds.append(parent.withColumnRenamed("a", "node"))
        # Links go both ways, so one side's parents are the other side's as well.
        half = join_lookup(left, parent, "a", hot_keys(left, "a")).select(F.col("parent").alias("x"), F.col("b").alias("a")).distinct()
        half = materialise(half)
        left = materialise(join_lookup(half, parent, "a", hot_keys(half, "a")).select(F.col("x").alias("a"), F.col("parent").alias("b")).filter("a <> b").distinct())
    if count:
        rounds.append(materialise(_joined(left)))
    if not rounds:
        return nodes.select("node", F.col("node").alias("comp"))
    final = rounds.pop().withColumnRenamed("parent", "comp")
    while rounds:
        step = rounds.pop()
        later = final.select(F.col("node").alias("parent"), "comp")
        of = step.select("parent").distinct().join(later, "parent", "left").select("parent", F.coalesce("comp", "parent").alias("comp"))
        final = materialise(join_lookup(step, of, "parent", hot_keys(step, "parent")).select("node", "comp"))
    return nodes.select("node").join(final, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))


def _classes(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, bands: int, rows: int, broadcast_ids: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row; a node is a distinct set."""
    sig = materialise(signatures(docs, id_col, text_col, k, bands, rows))
    named = sig.filter("doc_id is not null and n_shingles > 0")
    reps = named.groupBy("set_key").agg(F.min_by("bands", "doc_id").alias("bands"), F.min(F.struct("doc_id", "text_key")).alias("least"), F.count("*").alias("copies"))
    # Numbered as written, so the numbers stay whatever is run again.
    reps = materialise(reps.select(F.monotonically_increasing_id().alias("node"), "set_key", "bands", "least.doc_id", "least.text_key", "copies"))
    members = reps.select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = materialise(members.groupBy("band", "bucket").agg(F.min("node").alias("a"), F.count("*").alias("m")).filter("m > 1"))
    places = bands * reps.count()
    crowd = materialise(join_lookup(members, hubs.drop("m"), ["band", "bucket"], hot_among(hubs, ["band", "bucket"], "m", places)))
    pairs = materialise(crowd.filter("a <> node").select("a", F.col("node").alias("b")).distinct())
    nodes = materialise(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
    wanted = reps.select("node", "doc_id", "text_key").join(nodes, "node", "left_semi")
    sets = materialise(_sets_of(docs, wanted, id_col, text_col, k, broadcast_ids))
    stars = materialise(_confirm(pairs, sets, percent))
    first = components(nodes, stars)
    rest = materialise(_rest(crowd.select("band", "bucket", "node"), first, sets, percent))
    final = first if rest.isEmpty() else components(nodes, stars.union(rest))
    linked = materialise(final.join(reps.select("node", "set_key", "doc_id"), "node"))
    low = linked.groupBy("comp").agg(F.min("doc_id").alias("low"))
    moved = join_lookup(linked, low, "comp", hot_keys(linked, "comp")).filter("low <> doc_id").select("set_key", "low")
    classes = materialise(reps.select("set_key", "doc_id", "copies").join(moved, "set_key", "left").select("set_key", F.coalesce("low", "doc_id").alias("component_id"), "copies"))
    total = classes.agg(F.sum("copies")).first()[0] or 0
    placed = join_lookup(named.drop("bands"), classes.drop("copies"), "set_key", hot_among(classes, "set_key", "copies", total))
    placed = placed.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    alone = sig.filter("doc_id is null or n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "kept": F.lit(True)})
    columns = ["doc_id", "text_key", "n_shingles", "component_id", "kept"]
    return placed.select(columns).unionByName(alone.select(columns))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, bands: int = 72, rows: int = 6, broadcast_ids: int = 400_000
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs, each once.

    Ids are whole numbers. Null, empty or blank text: n_shingles 0, alone in its class.
    A null id: null class, kept, and linked with nothing. Rows of one id with different
    texts are documents of their own, each in the class of its text; component_id is
    the least id of any row in the class. Repeated rows: each is returned; kept is true
    for each of the least id. Other columns are ignored. An empty table gives no rows.
    """
    return _classes(docs, id_col, text_col, k, percent, bands, rows, broadcast_ids).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, bands: int = 72, rows: int = 6, broadcast_ids: int = 400_000) -> DataFrame:
    """docs without the near copies: one document of each class stays, with all its columns.

    Of rows of one id with different texts, those go whose own text is a near copy.
    Repeated rows of the kept document all stay.
    """
    found = _classes(docs, id_col, text_col, k, percent, bands, rows, broadcast_ids).filter("not kept")
    gone = found.select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct()
    same = (docs[id_col].cast("long") == F.col("__gone")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("__key"))
    return docs.join(gone, same, "left_anti")
