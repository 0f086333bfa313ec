"""N-gram Jaccard join: documents whose n-gram sets have a Jaccard similarity of at least a threshold, and their groups.

1. A document's set is its distinct word n-grams (64-bit hashes). Equal sets are one class with one representative.
2. A pair that reaches the threshold shares an n-gram among the rarest (1 - t) |set| + 1 of each (prefix bound). Any common
   order will do for that; frequent n-grams come last, found by counts over all documents. Documents that share a prefix
   n-gram are tied if neither their sizes (size bound) nor the parity maps of their sets (a bound of the sets' difference) rule out a link; the ties' components are candidate clusters.
   The documents of a hot n-gram are dealt to several tasks, whose lists are tied to each other.
3. In a cluster, document by n-gram incidence is multiplied by its transpose in blocks: blocks of columns within a task,
   tiles of about ``BLOCK`` documents and ``CELLS`` n-grams over tasks for large clusters, only between sizes that can reach the threshold. Overlap
   counts accumulate, and a product stops when what is left of the columns can lift no pair to its bound.
4. A task sends the links' spanning forest, not all pairs. In a large cluster, first each block is multiplied by itself and a few anchors; then blocks of documents outside its
   largest component meet all others that they could link with. Pairs inside one component need no further product.

Exact but for collisions of 64-bit hashes. Defined results: without words or text a set is empty and linked with nothing;
with fewer than n words the whole sequence is one n-gram. Rows of one id are one node. A row without id has a null component.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunked, collected, in_task, materialize, mix64, remove, table
from .components import connected_components

#: Documents of a tile's block, n-grams of all its documents together (or one document), columns of a block of the product.
BLOCK, CELLS, COLUMNS = 512, 500_000, 4096
#: Least bits of a parity map; documents of an n-gram that are compared with each other.
PARITY, LIST = 512, 4096
#: Documents of an n-gram whose pairs are listed, each pair once however many n-grams it shares; longer lists travel with a parity map for each document.
SHORT = 32
#: A group of equal sets, and a hot n-gram's documents, are dealt over at most so many parts.
SALTS = 64
#: Documents of a band that go to all its blocks.
ANCHORS = 8
#: A frequent n-gram has a count of at least this share of documents: at most (mean set size) / SHARE of them.
SHARE, LOCAL = 1 / 2000, 4
_MUL = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text; words end at ASCII white space, A-Z is folded."""
    offsets, codes, chunks = chunked(column, lower=True)
    filled = np.fromiter(map(bool, chunks), bool, len(chunks))[codes] if chunks else np.zeros(0, bool)
    if not filled.all():  # empty chunks at the ends of texts are no words
        offsets, codes = np.concatenate([[0], np.cumsum(filled)])[offsets], codes[filled]
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, chunks), np.uint64, len(chunks))[codes] if chunks else np.zeros(0, np.uint64)
    grams = _roll(words, n)
    out = []
    for at, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        size = end - at
        if size >= n:
            own = np.sort(grams[at : at + size - n + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif size:
            own = _roll(np.concatenate([words[at:end], np.full(n - size, size, np.uint64)]), n)[:1]
        else:
            own = grams[:0]
        out.append(own)
    return out


def _roll(words: np.ndarray, n: int) -> np.ndarray:
    if len(words) < n:
        return words[:0].view(np.int64)
    h = words[: len(words) - n + 1]
    for k in range(1, n):
        h = mix64(h * _MUL[0] + _MUL[1]) + words[k : len(words) - n + 1 + k] * _MUL[2]
    return mix64(h).view(np.int64)


def needed(x, y, percent: int):
    """The overlap that sets of x and y need: 100 * o >= percent * (x + y - o)."""
    return -((-percent * (x + y)) // (100 + percent))


def prefix_size(size: int, percent: int) -> int:
    """A partner of any size the bound allows shares at least ceil(t * size) n-grams, so one among so many of the first."""
    return size - -(-percent * size // 100) + 1 if size else 0


def frequent_ngrams(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of those in at least ``SHARE`` of all documents, sorted by n-gram. Tasks count in runs and send those that repeat."""
    rows = docs.count()
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def flush():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            use = counts >= LOCAL
            return pa.RecordBatch.from_arrays([pa.array(grams[use]), pa.array(counts[use].astype(np.int64))], schema=schema)

        for b in batches:
            sets = shingle_sets(b.column("text"), n)
            held += sets
            size += sum(map(len, sets))
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counted = docs.select("text").mapInArrow(in_task(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LOCAL, SHARE * rows))
    got = collected(counted).sort_values("gram")
    return got["gram"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def document_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, sig, bits, prefix, hot): size, 128-bit signature, parity bits and rarest n-grams of each document's set. ``hot`` has those of the prefix that more than
    ``LIST`` documents hold, each with the number of parts that its documents are dealt to."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_ngrams(docs, n))
    hot = pa.list_(pa.struct([("gram", pa.int64()), ("parts", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.binary()), ("bits", pa.binary()), ("prefix", pa.list_(pa.int64())), ("hot", hot)])

    def rare(s: np.ndarray) -> tuple[list[int], list[dict]]:
        grams, counts = shared.value
        size = prefix_size(len(s), percent)
        if not len(grams) or not len(s):
            return s[:size].tolist(), []
        at = np.minimum(np.searchsorted(grams, s), len(grams) - 1)
        times = np.where(grams[at] == s, counts[at], 0)
        order = np.argsort(times, kind="stable")[:size]
        s, times = s[order], times[order]
        plain = int(np.searchsorted(times, LIST, "right"))
        return s[:plain].tolist(), [{"gram": g, "parts": min(SALTS, -(-k // LIST))} for g, k in zip(s[plain:].tolist(), times[plain:].tolist(), strict=True)]

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column("text"), n)
            prefix, held = zip(*map(rare, sets), strict=True)
            yield table(schema, doc_id=b.column("doc_id"), n_shingles=list(map(len, sets)), sig=[xxhash.xxh3_128_digest(s.tobytes()) for s in sets], bits=list(map(parity_bits, sets)), prefix=prefix, hot=held)

    return docs.mapInArrow(in_task(run), "doc_id long, n_shingles long, sig binary, bits binary, prefix array<long>, hot array<struct<gram: long, parts: int>>")


def parity_bits(s: np.ndarray) -> bytes:
    """Of each residue of the hashes, whether an odd number of n-grams has it. Two such maps differ in at most as many bits as the sets in n-grams. Larger sets have
    longer maps; a map folded in halves by exclusive or is that of half the length."""
    size = PARITY
    while size < PARITY << 8 and size * 2 < len(s):
        size *= 4
    return np.packbits((np.bincount(s.view(np.uint64) % np.uint64(size), minlength=size) & 1).astype(np.uint8)).tobytes() if len(s) else b""


def may_link(n1: int, bits1: bytes, n2: int, bits2: bytes, percent: int) -> bool:
    """False only where sets of these sizes and parity maps cannot reach the threshold."""
    low, high = (n1, n2) if n1 < n2 else (n2, n1)
    if 100 * low < percent * high:
        return False
    while len(bits1) != len(bits2):
        a, b = (bits1, bits2) if len(bits1) > len(bits2) else (bits2, bits1)
        # residues of a quarter of the length: four parts fall on one
        q = len(a) // 4
        parts = [int.from_bytes(a[k * q : (k + 1) * q]) for k in range(4)]
        bits1, bits2 = (parts[0] ^ parts[1] ^ parts[2] ^ parts[3]).to_bytes(q), b
    differ = (int.from_bytes(bits1) ^ int.from_bytes(bits2)).bit_count()
    return differ <= n1 + n2 - 2 * needed(n1, n2, percent)


def list_forest(rows: list[tuple[int, int, bytes]], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of one n-gram's documents (size, id, parity map), sorted by size, that may link."""
    if len(rows) > 16:
        return _long_forest(rows, percent)
    root = list(range(len(rows)))
    out = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for j, (n2, d2, b2) in enumerate(rows):
        for i in range(j - 1, -1, -1):
            n1, d1, b1 = rows[i]
            if 100 * n1 < percent * n2:
                break
            if (a := find(i)) != (b := find(j)) and may_link(n1, b1, n2, b2, percent):
                root[b] = a
                if d1 != d2:
                    out.append((d1, d2))
    return out


def _long_forest(rows: list[tuple[int, int, bytes]], percent: int) -> list[tuple[int, int]]:
    """The same for many documents: each one reached is compared once with all that aren't yet, by maps of the shortest length."""
    n = np.array([r[0] for r in rows])
    d = [r[1] for r in rows]
    maps = np.zeros((len(rows), PARITY // 64), np.uint64)
    for i, (_, _, bits) in enumerate(rows):
        maps[i] = np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, PARITY // 64), axis=0)
    left = np.arange(len(rows))
    out = []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            a, z = np.searchsorted(n[left], [-(-percent * n[i] // 100), 100 * n[i] // percent + 1])
            near = left[a:z]
            differ = np.bitwise_count(maps[near] ^ maps[i]).sum(1)
            may = differ <= n[near] + n[i] - 2 * needed(n[near], n[i], percent)
            long = np.flatnonzero(may & (n[near] > 2 * PARITY)) if n[i] > 2 * PARITY else np.zeros(0, int)  # longer maps tell more
            may[long] = [may_link(*rows[i][::2], *rows[j][::2], percent) for j in near[long]]
            hit = near[may]
            out += [(d[i], d[j]) for j in hit.tolist() if d[i] != d[j]]
            todo += hit.tolist()
            left = np.concatenate([left[:a], near[~may], left[z:]])
    return out


def prefix_ties(reps: DataFrame, percent: int) -> DataFrame:
    """(a, b): ties of documents that share a prefix n-gram and may link. A list is that of an n-gram, or a part of a hot one's. Of lists of up to ``SHORT`` documents all pairs, distinct over all n-grams before
    parity maps are joined to them; of longer ones a forest for each. In lists of over ``LIST`` documents
    and in parts, each is tied to the first of its run of neighbouring sizes, and so are the runs of a hot n-gram's parts."""
    schema = pa.schema([("gram", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
    shape = "gram long, a long, b long, low long, high long"

    def emit(found: set):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    def run(batches):
        """Ties have ends a and b; a run of a hot n-gram's list has a document and the run's least and largest sizes."""
        key, rows, hub, low, last = None, [], None, 0, 0
        found: set[tuple] = set()

        def close():
            nonlocal rows, hub
            found.update((None, *p, None, None) for p in list_forest(rows, percent))
            if hub is not None and key[2] > 1:
                found.add((key[0], hub, None, low, last))
            rows, hub = [], None

        for b in batches:
            for gram, part, parts, n, d, bits in zip(*(b.column(k).to_pylist() for k in ("gram", "part", "parts", "n", "rep", "bits")), strict=True):
                if (gram, part, parts) != key:
                    close()
                    key = (gram, part, parts)
                if hub is None and len(rows) < LIST and parts == 1:
                    rows.append((n, d, bits))
                    continue
                for m, e in [(r[0], r[1]) for r in rows] + [(n, d)]:
                    if hub is None or 100 * last < percent * m:
                        if hub is not None and parts > 1:
                            found.add((gram, hub, None, low, last))
                        hub, low = e, m
                    elif hub != e:
                        found.add((None, hub, e, None, None))
                    last = m
                rows = []
            if len(found) > 100_000:
                yield emit(found)
                found.clear()
        close()
        if found:
            yield emit(found)

    def merge(batches):
        """Ties of a hot n-gram's runs, in order of their least sizes."""
        gram, hub, top = None, None, 0
        for b in batches:
            found = set()
            for g, d, low, high in zip(*(b.column(k).to_pylist() for k in ("gram", "a", "low", "high")), strict=True):
                if g != gram or 100 * top < percent * low:
                    gram, hub, top = g, d, high
                elif hub != d:
                    found.add((None, hub, d, None, None))
                top = max(top, high)
            if found:
                yield emit(found)

    part = F.pmod(F.xxhash64("rep", "gram"), F.col("parts")).cast("int")
    size = F.col("n_shingles").cast("int").alias("n")
    plain = reps.select(F.explode("prefix").alias("gram"), F.lit(1).alias("parts"), "rep", size)
    hot = reps.select(F.explode("hot").alias("h"), "rep", size).select("h.gram", "h.parts", "rep", "n")
    entries = plain.unionByName(hot).withColumn("part", part)
    held: list[str] = []
    # written, so the entries' shuffle files are gone when maps travel
    shared = materialize(entries.withColumn("k", F.count("*").over(Window.partitionBy("gram", "part"))).where("k > 1 or parts > 1"), "shared", held)
    short = (F.col("k") <= SHORT) & (F.col("parts") == 1)
    maps = reps.select("rep", F.col("n_shingles").alias("n"), "bits").hint("merge")
    few = _linkable(_list_pairs(shared.where(short), percent), maps, percent)
    described = shared.where(~short).select("gram", "part", "parts", "rep").join(maps, "rep")
    dealt = described.repartition("gram", "part").sortWithinPartitions("gram", "part", "parts", "n", "rep")
    found = materialize(dealt.mapInArrow(in_task(run), shape), "lists", held)
    runs = found.where("gram is not null").repartition("gram").sortWithinPartitions("gram", "low", "a").mapInArrow(in_task(merge), shape)
    ties = materialize(found.where("gram is null").unionByName(runs).select("a", "b").unionByName(few).distinct(), "ties")
    remove(reps.sparkSession, held)
    return ties


def _list_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): distinct pairs of documents of a list (gram, rep, n) whose sizes can reach the threshold."""
    lists = shared.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("n", "rep"))).alias("list"))
    first = lists.select("list", F.posexplode("list").alias("at", "x"))
    after = F.filter(F.expr("slice(list, at + 2, size(list))"), lambda y: (F.lit(100) * F.col("x.n").cast("long") >= F.lit(percent) * y["n"].cast("long")) & (y["rep"] != F.col("x.rep")))
    pairs = first.select("x", F.explode(after).alias("y"))
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def _linkable(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity maps (rep, n, bits) don't rule out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in batches:
            may = [may_link(*row, percent) for row in zip(*(b.column(c).to_pylist() for c in ("na", "bits_a", "nb", "bits_b")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], schema=schema).filter(pa.array(may, pa.bool_()))

    own = lambda c: maps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits_{c}")).hint("merge")
    return pairs.join(own("a"), "a").join(own("b"), "b").mapInArrow(in_task(run), "a long, b long")


def _banded(members: DataFrame, percent: int) -> DataFrame:
    """A pair's sizes lie in one band or in two neighbouring ones."""
    return members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int"))


def _upto(c: str):
    """0 to the value of a column less one; empty for null."""
    return F.when(F.coalesce(F.col(c), F.lit(0)) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))


def _cuts(k, cells):
    """Blocks of ``k`` documents with ``cells`` n-grams in all: a document in each at most."""
    return F.least(k, F.greatest(F.ceil(k / BLOCK), F.ceil(cells / CELLS))).cast("int")


def first_tiles(members: DataFrame, percent: int) -> DataFrame:
    """(rep, cluster, n, whole, tiles): a cluster of up to ``BLOCK`` documents is one tile (``whole``). Larger ones are cut into bands of sizes and blocks by a hash,
    a document to one block; about ``ANCHORS`` documents of a band go to all blocks that they can link with, to tie those together."""
    banded = _banded(members, percent)
    sizes = banded.groupBy("cluster", "band").agg(F.count("*").alias("k"), F.sum("n").alias("cells"))
    whole = sizes.groupBy("cluster").agg(F.sum("k").alias("total"), F.sum("cells").alias("all_cells"))
    cuts = sizes.withColumn("cuts", _cuts(F.col("k"), F.col("cells"))).drop("cells")
    near = lambda d, name: cuts.select("cluster", (F.col("band") + d).alias("band"), F.col("cuts").alias(name))
    plan = cuts.join(near(-1, "above"), ["cluster", "band"], "left").join(near(1, "below"), ["cluster", "band"], "left").join(whole, "cluster")
    at = banded.join(plan, ["cluster", "band"])
    name = lambda d: lambda s: F.concat_ws(":", F.col("band") + d, s)
    everywhere = F.concat(F.transform(_upto("cuts"), name(0)), F.transform(_upto("above"), name(1)), F.transform(_upto("below"), name(-1)))
    anchor = F.pmod(F.xxhash64("rep", F.lit(1)), F.ceil(F.col("k") / ANCHORS)) == 0
    own = F.array(name(0)(F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")))
    small = (F.col("total") <= BLOCK) & (F.col("all_cells") <= CELLS)
    return at.select("rep", "cluster", "n", small.alias("whole"), F.when(small, F.array(F.lit("-"))).when(anchor, everywhere).otherwise(own).alias("tiles"))


def last_tiles(members: DataFrame, percent: int) -> DataFrame:
    """(rep, tiles) of members (rep, cluster, n, component) of large clusters whose blocks' components are not one yet. Documents of a cluster's largest component are linked
    already, so only the others' blocks meet all blocks of their own and the neighbouring bands."""
    counted = members.groupBy("cluster", "component").agg(F.count("*").alias("k"))
    largest = counted.groupBy("cluster").agg(F.max(F.struct("k", "component")).alias("m"), F.count("*").alias("components")).where("components > 1").select("cluster", F.col("m.component").alias("largest"))
    banded = _banded(members.join(largest, "cluster"), percent).withColumn("other", F.col("component") != F.col("largest"))
    cut = lambda test: F.coalesce(_cuts(F.count_if(test), F.sum(F.when(test, F.col("n")))), F.lit(0))
    cuts = banded.groupBy("cluster", "band").agg(cut(F.col("other")).alias("o0"), cut(~F.col("other")).alias("g0"))
    near = lambda d, mark: cuts.select("cluster", (F.col("band") + d).alias("band"), F.col("o0").alias(f"o{mark}"), F.col("g0").alias(f"g{mark}"))
    plan = cuts.join(near(-1, "1"), ["cluster", "band"], "left").join(near(1, "2"), ["cluster", "band"], "left")
    at = banded.join(plan, ["cluster", "band"])
    block = F.pmod(F.xxhash64("rep"), F.when(F.col("other"), F.col("o0")).otherwise(F.col("g0"))).cast("int")
    own = F.concat_ws(":", F.when(F.col("other"), "o").otherwise("g"), "band", block)

    def meet(kind: str, mark: str, d: int):
        return F.transform(_upto(kind + mark), lambda s: F.array_join(F.array_sort(F.array(own, F.concat_ws(":", F.lit(kind), F.col("band") + d, s))), "|"))

    others = F.concat(*[meet("o", m, d) for m, d in (("0", 0), ("1", 1), ("2", -1))])
    rest = F.concat(*[meet("g", m, d) for m, d in (("0", 0), ("1", 1), ("2", -1))])
    return at.select("rep", F.array_distinct(F.when(F.col("other"), F.concat(others, rest)).otherwise(others)).alias("tiles"))


def link_forest(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of a tile's links, each document to the smallest of its component: the blocked product of incidence with its transpose."""
    d = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rows = np.repeat(np.arange(d), sizes)
    grams, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = counts[columns] > 1  # a column of one document adds to no pair
    rows, (kept, columns) = rows[use], np.unique(columns[use], return_inverse=True)
    bound = needed(sizes[:, None], sizes[None, :], percent)
    overlap = np.zeros((d, d), np.float32)
    left = np.bincount(rows, minlength=d)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for start in range(0, len(kept), COLUMNS):
        a, z = np.searchsorted(columns, [start, start + COLUMNS])
        block = np.zeros((d, min(COLUMNS, len(kept) - start)), np.float32)
        block[rows[a:z], columns[a:z] - start] = 1
        overlap += block @ block.T
        left = left - np.bincount(rows[a:z], minlength=d)
        open_ = overlap + np.minimum(left[:, None], left[None, :]) >= bound
        np.fill_diagonal(open_, False)
        if not open_.any():
            return []
    linked = overlap >= bound
    forest, seen = [], np.zeros(d, bool)
    for i in np.argsort(ids, kind="stable"):
        if seen[i]:
            continue
        seen[i] = True
        todo = [i]
        while todo:
            for j in np.flatnonzero(linked[todo.pop()] & ~seen):
                seen[j] = True
                forest.append((int(ids[i]), int(ids[j])))
                todo.append(j)
    return forest


def _multiply(placed: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b, whole): the links' spanning forest of every tile of (rep, cluster, tile, whole, text)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("whole", pa.bool_())])

    def run(batches):
        # rows come sorted by tile; a tile is multiplied when its last row has come
        key, ids, held, whole = None, [], [], True
        found: list[tuple[int, int, bool]] = []
        for b in batches:
            for cluster, tile, rep, w, s in zip(*(b.column(c).to_pylist() for c in ("cluster", "tile", "rep", "whole")), shingle_sets(b.column("text"), n), strict=True):
                if (cluster, tile) != key:
                    found += [(*p, whole) for p in link_forest(np.array(ids), held, percent)] if len(ids) > 1 else []
                    key, ids, held, whole = (cluster, tile), [], [], w
                    if len(found) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], schema=schema)
                        found = []
                ids.append(rep)
                held.append(s)
        found += [(*p, whole) for p in link_forest(np.array(ids), held, percent)] if len(ids) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], schema=schema)

    dealt = placed.select("rep", "cluster", "tile", "whole", "text").repartition("cluster", "tile").sortWithinPartitions("cluster", "tile", "rep")
    return dealt.mapInArrow(in_task(run), "a long, b long, whole boolean").where("a <> b")


def equal_sets(filled: DataFrame) -> DataFrame:
    """(doc_id, rep): the smallest id of the documents with an equal set. A group is dealt by a hash of its ids, so a hot one meets in no task: first the parts find their smallest ids, then the group that of its parts."""
    salted = filled.select("doc_id", "sig", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = salted.groupBy("sig", "salt").agg(F.min("doc_id").alias("least"))
    whole = parts.groupBy("sig").agg(F.min("least").alias("rep"))
    up = parts.select("sig", "salt").join(whole.hint("merge"), "sig")
    return salted.join(up.hint("merge"), ["sig", "salt"]).select("doc_id", "rep")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id): for each row the size of its set and the smallest id that links reach from it."""
    spark = docs.sparkSession
    held: list[str] = []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = materialize(document_sets(rows, n, percent), "sets", held)
    filled = sets.where("n_shingles > 0 and doc_id is not null")
    member = materialize(equal_sets(filled), "classes")
    # joins are merged at every size: what a broadcast would save on small tables makes the large ones no lighter
    reps = filled.join(member.where("doc_id = rep").select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").withColumnRenamed("doc_id", "rep")
    clusters = connected_components(prefix_ties(reps, percent)).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    sizes = filled.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"))
    placed = materialize(first_tiles(sizes.join(clusters, "rep").distinct(), percent), "placed", held)
    # the texts of candidates, written once for both rounds; they are lighter than their sets
    candidates = materialize(rows.withColumnRenamed("doc_id", "rep").join(placed.hint("merge"), "rep"), "candidates", held)
    links = materialize(_multiply(candidates.select("rep", "cluster", "whole", "text", F.explode("tiles").alias("tile")), n, percent), "links")
    single = links.where("whole").select(F.col("b").alias("rep"), F.col("a").alias("component"))
    large = candidates.where("not whole").select("rep", "cluster", "n").distinct()
    roots = single
    if large.limit(1).count():
        tied = connected_components(links.where("not whole")).select(F.col("node").alias("rep"), "component")
        members = large.join(tied, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        rest = candidates.where("not whole").select("rep", "cluster", "whole", "text").join(last_tiles(members, percent), "rep").withColumn("tile", F.explode("tiles"))
        more = materialize(_multiply(rest, n, percent), "links")
        joined = connected_components(links.where("not whole").unionByName(more))
        roots = single.unionByName(joined.select(F.col("node").alias("rep"), "component"))
    grouped = member.distinct().join(roots, "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    sized = materialize(sets.select("doc_id", "n_shingles"), "sizes")
    remove(spark, held)
    return sized.join(grouped, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: those of the group's smallest id, one for each text that this id has. Among rows that repeat id and text the one with the
    smallest hash of all columns stays. Rows without an id stay."""
    groups = near_duplicates(docs, n=n, percent=percent)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    # dealt by the id already; rows of an id are few
    own = Window.partitionBy("doc_id", "_text").orderBy("_row")
    kept = docs.join(first, "doc_id", "left_semi").withColumns({"_text": F.sha1(F.col("text").cast("binary")), "_row": F.xxhash64(*docs.columns)})
    one = kept.withColumn("_k", F.row_number().over(own)).where("_k = 1").select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))
