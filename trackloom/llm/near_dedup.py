"""Near-duplicate detection: BagMinHash signatures of shingle multisets, banding, verification, classes.

A document is the multiset of its ``SHINGLE``-word shingles (lower-cased, words between white space; a shorter text is one shingle of all its words). Per shingle of weight w, independent Poisson processes run on the dyadic weight intervals (0, 1], (1, 2], (2, 4], ... up to w; their points fall on a component, a weight and a time at random, and points above w are thinned out. A component keeps its first point. Two documents share it with a probability of their weighted Jaccard similarity, so the signature is unbiased, and a shingle costs one hash unless its first arrival comes early enough to matter.

Documents with the same multiset are one node. Nodes that agree in a band of ``ROWS`` components share a bucket, and a pair that shares one is linked when the overlap of the two multisets is at least ``THRESHOLD`` of their union. No bucket is expanded into pairs: see ``_classes``. Signatures only choose what is verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_group, discard, materialize, table, text_or_empty, tidy

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 4
COMPONENTS = BANDS * ROWS
BATCH_WORDS = 1 << 17
CACHE_WORDS = 1 << 17
#: Least agreement of two signatures for a pair to be verified: over six standard deviations below a similarity of 0.8.
LEAST_AGREEMENT = 0.5
#: Most rounds in which nodes meet the most similar ones, before what is open is compared whole.
ROUNDS = 4
#: Bounds of a task that compares nodes of a bucket: signatures, or texts and their shingles, on each of its two sides.
BLOCK_SIGNATURES = 4096
BLOCK_NODES = 512
#: What a row does in such a task.
ASKS, ASKED = 1, 2
TASK = ["band", "p", "t"]
BLOCK_SHINGLES = 1 << 18
_P, _A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; works in place."""
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    x *= _P
    x ^= x >> np.uint64(32)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


class Words(dict):
    """64-bit hashes of words, kept while there are at most ``CACHE_WORDS``."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def multisets(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingle hashes of all texts one after the other, their counts, and where each text's begin (one more at the end)."""
    split = [t.lower().split() for t in texts]
    lengths = np.array([len(s) for s in split], np.int64)
    flat = np.fromiter((words[w] for s in split for w in s), np.uint64, int(lengths.sum()))
    at = np.concatenate(([0], np.cumsum(lengths)))
    rolled = flat[: max(0, len(flat) - SHINGLE + 1)].copy()
    for i in range(1, SHINGLE):
        rolled = rolled * _P + flat[i : len(flat) - SHINGLE + 1 + i]
    rolled = _mix(rolled)
    values, counts, cuts = [], [], [0]
    for i, n in enumerate(lengths.tolist()):
        lo = int(at[i])
        if n >= SHINGLE:
            v = np.sort(rolled[lo : lo + n - SHINGLE + 1])
            first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
            values.append(v[first])
            counts.append(np.diff(first, append=len(v)))
        elif n:
            whole = np.array([n], np.uint64)
            for w in flat[lo : lo + n]:
                whole = whole * _A ^ w
            values.append(_mix(whole))
            counts.append(np.ones(1, np.int64))
        cuts.append(cuts[-1] + (len(values[-1]) if n else 0))
    if not values:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.array(cuts)
    return np.concatenate(values), np.concatenate(counts), np.array(cuts)


def signatures(values: np.ndarray, counts: np.ndarray, cuts: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (texts x m point ids); all zero for a text without shingles."""
    n = len(cuts) - 1
    out = np.zeros((n, m), np.uint64)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    total = np.bincount(doc, counts, n) if len(doc) else np.zeros(n)
    # One row for each shingle and dyadic interval: its text, its seed, the interval's lower end (0 for the first) and the shingle's weight.
    owner, seed, low, weight = [doc], [values + _A], [np.zeros(len(doc))], [counts]
    k, rest = 0, np.flatnonzero(counts > 1)
    while len(rest):
        owner.append(doc[rest])
        seed.append(values[rest] + _A * np.full(1, k + 2, np.uint64))
        low.append(np.full(len(rest), 2.0**k))
        weight.append(counts[rest])
        k += 1
        rest = rest[counts[rest] > 2**k]
    owner, seed, low, weight = (np.concatenate(x) for x in (owner, seed, low, weight))
    seed = _mix(seed)
    length = np.maximum(low, 1.0)
    rate = length * m
    first = -np.log(_unit(_mix(seed + _B))) / rate
    todo, horizon = total > 0, np.where(total > 0, (np.log(m) + 4.0) / np.maximum(total, 1), 0.0)
    while todo.any():
        best, ids = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
        live = np.flatnonzero(todo[owner] & (first <= horizon[owner]))
        when, step, keys, times, points = first[live], 1, [], [], []
        while len(live):
            s = seed[live]
            point = _mix(s + _A * np.full(1, 2 * step, np.uint64))
            ok = low[live] + length[live] * _unit(_mix(point + _B)) <= weight[live]
            keys.append((owner[live] * m + (point % np.uint64(m)).astype(np.int64))[ok])
            times.append(when[ok])
            points.append(point[ok])
            when = when - np.log(_unit(_mix(s + _A * np.full(1, 2 * step + 1, np.uint64)))) / rate[live]
            more = when <= horizon[owner[live]]
            live, when, step = live[more], when[more], step + 1
        if keys:
            key, t, p = np.concatenate(keys), np.concatenate(times), np.concatenate(points)
            np.minimum.at(best, key, t)
            hit = t == best[key]
            ids[key[hit]] = p[hit]
        full = todo & np.isfinite(best.reshape(n, m)).all(axis=1)
        out[full] = ids.reshape(n, m)[full]
        todo &= ~full
        horizon = horizon * 2
    return out


PROFILE = "doc_id long, tag long, node binary, bands array<long>, signature binary, shingles long"


def _profile(batches):
    import xxhash

    words = Words()
    for batch in batches:
        ids, tags, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size < 6 * BATCH_WORDS):
                size += len(texts[hi])
                hi += 1
            values, counts, cuts = multisets(texts[lo:hi], words)
            sig = signatures(values, counts, cuts)
            nodes = [xxhash.xxh3_128_digest(values[a:b].tobytes() + counts[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            bands = sig.reshape(-1, BANDS, ROWS)
            mixed = np.zeros((hi - lo, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                mixed = _mix(mixed * _A + bands[:, :, r])
            some = np.diff(cuts) > 0
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some * BANDS))).astype(np.int32)), pa.array(mixed[some].ravel().view(np.int64)))
            low = np.ascontiguousarray((sig & np.uint64(0xFF)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), tags.slice(lo, hi - lo), pa.array(nodes, pa.binary()), listed, pa.array([x.tobytes() for x in low], pa.binary()), pa.array(np.diff(np.concatenate(([0], np.cumsum(counts)))[cuts]))], ["doc_id", "tag", "node", "bands", "signature", "shingles"])
            lo = hi


def _overlap(a, b) -> float:
    """Weighted Jaccard similarity of two multisets (values, counts)."""
    (va, ca), (vb, cb) = a, b
    at = np.minimum(np.searchsorted(vb, va), max(0, len(vb) - 1))
    same = vb[at] == va if len(vb) else np.zeros(len(va), bool)
    both = np.minimum(ca[same], cb[at[same]]).sum()
    return float(both / (ca.sum() + cb.sum() - both))


def _verify(threshold: float):
    def run(batches):
        words, kept = Words(), {}

        def of(node, text):
            if node not in kept:
                if len(kept) > 256:
                    kept.clear()
                kept[node] = multisets([text], words)[:2]
            return kept[node]

        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            sims = [_overlap(of(x, p), of(y, q)) for x, y, p, q in zip(a.to_pylist(), b.to_pylist(), ta.to_pylist(), tb.to_pylist(), strict=True)]
            keep = pa.array([s >= threshold for s in sims])
            yield pa.RecordBatch.from_arrays([a, b, pa.array(sims)], ["a", "b", "similarity"]).filter(keep)

    return run


def _texts(wanted: DataFrame, nodes: DataFrame, base: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes, fetched once a node by the document that stands for it."""
    wanted = nodes.join(wanted, "node", "left_semi").select("node", "stand_in", F.col("tag").alias("of_tag"))
    return materialize(base.join(wanted, base.doc_id.eqNullSafe(wanted.stand_in) & (base.tag == wanted.of_tag)).select("node", "text").dropDuplicates(["node"]), "texts")


def _links(pairs: DataFrame, nodes: DataFrame, base: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose texts reach the threshold."""
    texts = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, base)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    out = materialize(rows.mapInArrow(tidy(_verify(threshold)), "a binary, b binary, similarity double").select("a", "b"), "links")
    discard(texts)
    return out


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; a component is named by its least node.

    Every link points from its larger node to its smaller one. Each round first sends every link on to the least node that its smaller end points to (large-star), then points a node and all that it points to at the least of them (small-star), until each node points to one root that points nowhere. The number of links never grows, and rounds grow with the logarithm of the nodes, not with the length of chains. Links are never collected. Links that are not closed after ``rounds`` are an error.
    """
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    for _ in range(rounds):
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
        further = links.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "b")
        large = materialize(links.join(further, "b", "left").select("a", F.coalesce("least", "b").alias("b")).distinct(), "stars")
        discard(links)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        links = materialize(least.union(large.join(least, "a").where("b <> least").select("b", "least")).toDF("a", "b").distinct(), "stars")
        discard(large)
    raise RuntimeError(f"links are not closed to components after {rounds} rounds")


def _merged(names: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after ``links`` between nodes have joined components of ``names``; only the components that links touch are closed again."""
    if names is None:
        return materialize(components(links), "names")
    of = lambda end: names.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = components(between)
    renamed = names.join(joined.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return materialize(renamed.unionByName(joined.join(names.select("node"), "node", "left_anti")), "names")


def _agreement(least: float):
    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COMPONENTS) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return run


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those pairs (a, b) that their signatures do not rule out."""
    sig = nodes.select("node", "signature")
    pairs = pairs.join(sig.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
    return materialize(pairs.select("a", "b", "sa", "sb").mapInArrow(_agreement(LEAST_AGREEMENT), "a binary, b binary"), "pairs")


def _open(shared: DataFrame, names: DataFrame) -> DataFrame:
    """(band, node, component, probe) of the buckets that hold several components. Every pair of different components has a node outside the bucket's largest component: those are the probes."""
    named = shared.join(names, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    sizes = named.groupBy("band", "component").agg(F.count("*").alias("n")).groupBy("band").agg(F.max(F.struct("n", "component")).alias("largest"), F.count("*").alias("components")).where("components > 1")
    return materialize(named.join(sizes, "band").select("band", "node", "component", (F.col("component") != F.col("largest.component")).alias("probe")), "open")


def _dealt(rows: DataFrame, weight: Column, block: int) -> DataFrame:
    """Rows (band, probe, ...) laid out for tasks (band, p, t) of bounded size, in which the ``p``-th block of a bucket's probes asks the ``t``-th block of all its nodes; ``role`` tells which a row does.

    ``weight`` is a row's share of ``block``. A bucket that fits one block, as nearly all do, is one task and gets each row once.
    """
    blocks = rows.groupBy("band").agg(F.ceil(F.sum(weight) / block).cast("int").alias("ts"), F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("probe"), weight)) / block)).cast("int").alias("ps"))
    h = F.xxhash64("band", "node")
    at = lambda n: F.pmod(h, F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spot = lambda p, t, role: F.struct(p.alias("p"), t.alias("t"), F.lit(role).alias("role"))
    asked, asks = F.transform(every("ps"), lambda p: spot(p, at("ts"), ASKED)), F.transform(every("ts"), lambda t: spot(at("ps"), t, ASKS))
    alone = (F.col("ps") == 1) & (F.col("ts") == 1)
    spots = F.when(~F.col("probe"), asked).when(alone, F.array(spot(F.lit(0), F.lit(0), ASKS | ASKED))).otherwise(F.concat(asked, asks))
    kept = [c for c in rows.columns if c != "probe"]
    return rows.join(blocks, "band").withColumn("spot", F.explode(spots)).select(*kept, "spot.p", "spot.t", "spot.role")


def _codes(column) -> np.ndarray:
    """A number for each distinct value."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _roles(rows) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows that ask, and of those that are asked."""
    role = rows.column("role").to_numpy()
    return np.flatnonzero(role & ASKS), np.flatnonzero(role & ASKED)


def _meet(rows):
    """Of a task's rows: numbers of those that ask and of those asked, a component code of each row, and the agreement of the signatures (asking x asked), 0 inside a component."""
    ask, other = _roles(rows)
    code, sig = _codes(rows.column("component")), np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, COMPONENTS)
    if len(ask) * len(other) <= 1 << 10:
        agree = (sig[ask][:, None] == sig[other]).sum(axis=2, dtype=np.uint8)
    else:  # a component at a time, so that no array is larger than the pairs
        right, agree = np.ascontiguousarray(sig[other].T), np.zeros((len(ask), len(other)), np.uint8)
        for c, left in enumerate(sig[ask].T):
            agree += left[:, None] == right[c]
    agree[code[ask][:, None] == code[other]] = 0
    return ask, other, code, agree


def _best(key, rows):
    """For each asking node the node of another component whose signature agrees most, if it is plausible."""
    ask, other, _, agree = _meet(rows)
    if not len(other):
        return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "agree": pa.array([], pa.int32())})
    best = agree.argmax(axis=1)
    most = agree[np.arange(len(ask)), best]
    good, node = most >= LEAST_AGREEMENT * COMPONENTS, rows.column("node")
    return pa.table({"a": node.take(pa.array(ask[good])), "b": node.take(pa.array(other[best[good]])), "agree": pa.array(most[good].astype(np.int32))})


def _suspects(key, rows):
    """The nodes of pairs that are plausible, of different components, and share no earlier band."""
    band = key[0]
    ask, other, _, agree = _meet(rows)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    found = np.zeros(rows.num_rows, bool)
    for lo in range(0, len(ask), 16):
        x, y = np.nonzero(agree[lo : lo + 16] >= LEAST_AGREEMENT * COMPONENTS)
        a, b = ask[lo + x], other[y]
        first = (bands[a] == bands[b]).argmax(axis=1)
        here = bands[a, first] == band
        found[a[here]] = found[b[here]] = True
    return rows.select(["band", "node"]).filter(pa.array(found))


def _similarities(values: np.ndarray, counts: np.ndarray, cuts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarities of all left with all right texts. A shingle of count c is c elements of its own, so overlaps are products of 0/1 matrices, made for some thousand elements at a time."""
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    level = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    element, text = _mix(np.repeat(values, counts) + level.astype(np.uint64) * _A), np.repeat(text, counts)
    total = np.bincount(text, minlength=len(cuts) - 1)
    _, column, times = np.unique(element, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1  # elements of one text only meet nothing
    keep = times[column] > 1
    column, text = number[column[keep]], text[keep]
    order = np.argsort(column, kind="stable")
    column, text = column[order], text[order]
    both = np.zeros((len(left), len(right)))  # sums of whole numbers, so exact
    last = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, last, 4096):
        at = slice(*np.searchsorted(column, (lo, lo + 4096)))
        x = np.zeros((len(cuts) - 1, min(4096, last - lo)), np.float32)
        x[text[at], column[at] - lo] = 1
        both += x[left] @ x[right].T
    return both / np.maximum(total[left][:, None] + total[right][None, :] - both, 1)


def _compare(threshold: float):
    """Links between components among a task's rows, by their whole texts; at most one fewer than the components it holds."""

    def run(key, rows):
        nodes, texts = rows.column("node").to_pylist(), rows.column("text").to_pylist()
        number = _codes(rows.column("node"))
        _, one = np.unique(number, return_index=True)  # a probe may be there in both roles
        values, counts, cuts = multisets([texts[i] for i in one], Words())
        ask, other, code = *_roles(rows), _codes(rows.column("component"))
        near = _similarities(values, counts, cuts, number[ask], number[other]) >= threshold
        root, links = list(range(int(code.max()) + 1)), []

        def find(n):
            while root[n] != n:
                root[n] = n = root[root[n]]
            return n

        while True:  # each time a row that asks is joined to one other at most, until no two components are near
            near &= code[ask][:, None] != code[other]
            some = np.flatnonzero(near.any(axis=1))
            if not len(some):
                break
            for a, b in zip(ask[some].tolist(), other[near[some].argmax(axis=1)].tolist(), strict=True):
                p, q = find(int(code[a])), find(int(code[b]))
                if p != q:
                    root[p] = q
                    links.append((nodes[a], nodes[b]))
            code = np.array([find(n) for n in range(len(root))])[code]
        return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

    return run


def _classes(shared: DataFrame, nodes: DataFrame, base: DataFrame, threshold: float) -> DataFrame:
    """(node, component) of nodes that share buckets (band, node, centre), linked where the multisets of two nodes of a bucket reach the threshold.

    Each step works on what those before left in different components. A node meets one centre, the least of its buckets. Then, as long as that joins many, a node meets the one of its buckets whose signature agrees most with its own and that it has not met. At last whatever pairs are still open and not ruled out by their signatures are compared by their whole texts, in tasks of bounded size that return a spanning set of links. The first steps send at most one pair a node and the last sends no pairs at all, so none grows with the square of a bucket; all treat buckets of every size alike.
    """
    first = shared.where("node <> centre").groupBy(F.col("node").alias("b")).agg(F.min("centre").alias("a")).select("a", "b")
    tested = _plausible(first, nodes)
    names = _merged(None, _links(tested, nodes, base, threshold))

    about = nodes.select("node", "signature", "bands")
    for _ in range(ROUNDS):
        left = _open(shared, names)
        found = by_group(_dealt(left, F.lit(1.0), BLOCK_SIGNATURES).join(about.drop("bands"), "node"), TASK, "node", _best, "a binary, b binary, agree int")
        found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("a").alias("asker"), "agree").join(tested, ["a", "b"], "left_anti")
        pairs = materialize(found.groupBy("asker").agg(F.max(F.struct("agree", "a", "b")).alias("best")).select("best.a", "best.b").distinct(), "pairs")
        links = _links(pairs, nodes, base, threshold)
        names, few = _merged(names, links), links.count() < pairs.count() / 8
        tested = tested.unionByName(pairs)
        discard(left)
        if few:
            break

    left = _open(shared, names)
    suspects = by_group(_dealt(left, F.lit(1.0), BLOCK_SIGNATURES).join(about, "node"), TASK, "node", _suspects, "band long, node binary")
    suspects = materialize(left.join(suspects.distinct(), ["band", "node"], "left_semi"), "suspects")
    texts = _texts(suspects.select("node"), nodes, base)
    share = F.greatest(F.lit(1.0), F.col("shingles") * (BLOCK_NODES / BLOCK_SHINGLES))
    rows = _dealt(suspects.join(nodes.select("node", "shingles"), "node"), share, BLOCK_NODES).drop("shingles").join(texts, "node")
    links = materialize(by_group(rows, TASK, "node", _compare(threshold), "a binary, b binary"), "links")
    names = _merged(names, links)
    for x in (left, suspects, texts, links):
        discard(x)
    return names


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, tag (a hash of the text).

    ``class_id`` is the least doc_id of the class, and its row stays. A null text counts as empty, and texts without words form one class. A null id is larger than any other; only a class of null ids has a null class_id. Of rows that repeat an id and text exactly one is kept. An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tag", F.xxhash64("text"))
    rows = materialize(base.select("doc_id", "tag", "text").mapInArrow(tidy(_profile), PROFILE).withColumn("row", F.monotonically_increasing_id()), "profiles")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "tag"))
    nodes = rows.groupBy("node").agg(best.alias("best"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature"), F.first("shingles").alias("shingles"))
    nodes = materialize(nodes.select("node", "best", "n", "bands", "signature", "shingles", F.col("best.doc_id").alias("stand_in"), F.col("best.tag").alias("tag")), "nodes")

    members = nodes.select("node", F.explode("bands").alias("band"))
    centres = members.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(members.join(centres, "band").select("band", "node", "centre"), "shared")
    names = _classes(shared, nodes, base, threshold)
    discard(shared)

    named = nodes.join(names, "node", "left").select("node", "n", "best", F.coalesce("component", "node").alias("component"))
    groups = named.groupBy("component").agg(F.min("best").alias("first"), F.sum("n").alias("class_size"))
    of = named.join(groups, "component").select("node", "first", "class_size")
    return rows.select("doc_id", "tag", "node", "row").join(of, "node").select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept"), "tag")


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each class one document, with the least id. Of rows that repeat that id and text one stays, whichever comes first.

    Only rows whose id and text repeat among the kept ones are brought together, and only if there are any.
    """
    names = docs.columns
    rows = near_dedup(docs, id_col=id_col, text_col=text_col, threshold=threshold).groupBy(F.col("doc_id").alias("kept_id"), F.col("tag").alias("kept_tag"))
    kept = materialize(rows.agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("kept").drop("kept"), "kept")
    # By position, as the caller's columns may have any names.
    keyed = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumns({"of_id": F.col(f"c{names.index(id_col)}").cast("long"), "of_tag": F.xxhash64(text_or_empty(f"c{names.index(text_col)}"))})

    def of(keys: DataFrame) -> DataFrame:
        return keyed.join(keys, F.col("of_id").eqNullSafe(F.col("kept_id")) & (F.col("of_tag") == F.col("kept_tag")), "left_semi")

    out, repeated = of(kept), kept.where("n > 1")
    if not repeated.isEmpty():
        out = of(kept.where("n = 1")).unionByName(of(repeated).dropDuplicates(["of_id", "of_tag"]))
    return out.drop("of_id", "of_tag").toDF(*names)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("tag")


QUERIES = {"op2_near_dedup": op2_near_dedup}
ORACLES: dict = {}
