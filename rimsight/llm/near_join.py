"""N-gram Jaccard join by PartEnum signatures, as components of linked documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rimsight.llm import words as W
from rimsight.llm.columns import doc_key
from rimsight.llm.components import components
from rimsight.llm.shared import held, ship_package
from rimsight.llm.sieve import bits_for, passes, sieve_of

GRAM = 5
BAND = 1.7  # sizes of one band differ by no more than this factor
MOST_BITS = 1 << 28  # of the sieve that picks the sets to count
GROUP = 1024  # members of a signature's group that are compared at a time
CHUNK_ROWS = 40_000
LEAST = 4  # elements of the smallest set that links with one not equal to it
SMALL = 8  # sets of up to so many elements have signatures of the whole set and of all but one element

# Jaccard 0.8: sets of a and b elements link when they differ in no more than (a + b) / 9 elements,
# so b lies between 0.8 a and 1.25 a.


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the texts' offsets."""
    hashes, ends, _ = W.word_hashes(*W.utf8(texts), W.BLANK_SPLIT)
    all_grams = W.grams(hashes, GRAM)
    sets, sizes = [], np.zeros(len(ends), np.int64)
    for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if b - a >= GRAM:
            own = np.unique(all_grams[a : b - GRAM + 1])
        elif b > a:  # the whole sequence of fewer words
            own = W.grams(hashes[a:b], b - a)[:1] + np.uint64(b - a)
        else:
            continue
        sets.append(own)
        sizes[k + 1] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(sizes)


def bands(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band of each size, and the largest size of the band."""
    band = np.floor(np.log(np.maximum(sizes, 1)) / np.log(BAND) + 1e-9).astype(np.int64)
    return band, upper(band)


def upper(band: np.ndarray) -> np.ndarray:
    return np.ceil(np.power(BAND, band + 1) - 1e-6).astype(np.int64)


def partitions(top: np.ndarray) -> np.ndarray:
    """Parts of the domain for sets of at most ``top`` elements: more than linked ones can differ in."""
    most = 2 * top // 9 + 1
    return most + (most + 19) // 20 + 1


def signatures(sets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of each set: (owner, signature).

    The domain is cut into more parts than the elements in which two linked sets of a band
    can differ, so they agree on a part: its elements' sum with the band and the part's
    number is a signature. An empty part counts only for sets with so few filled parts that
    a partner might share none of those. A set whose partners may lie in the next band has
    that band's signatures too.

    Sets of fewer than ``SMALL`` elements would mostly share empty parts. They link with sets
    of at most ``SMALL`` and differ from those in one element at most, so both have the sum of
    all elements, and the sums of all but one, as signatures instead; sets of ``SMALL`` have
    both kinds.
    """
    sizes = np.diff(ends)
    band, top = bands(sizes)
    owners, found = _small_signatures(sets, sizes)
    for ahead in (0, 1):
        group = band + ahead
        limit = top if not ahead else upper(group)
        # into the next band only where 1.25 times the size reaches it
        member = (sizes >= SMALL) & ((ahead == 0) | (5 * sizes >= 4 * top))
        parts = np.where(member, partitions(limit), 0)
        base = np.cumsum(parts) - parts
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = member[owner]
        owner_in, values = owner[inside], W.mix(sets[inside] ^ np.uint64(0x5851F42D4C957F2D))
        slot = base[owner_in] + (values % parts[owner_in].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, slot, W.mix(values))
        filled = np.bincount(slot, minlength=len(sums)) > 0
        of = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(len(sums)) - base[of]
        n_filled = np.bincount(of[filled], minlength=len(sizes))
        needs_empty = n_filled <= (9 * sizes) // 36 + 1  # a partner has at most 1.25 times the elements
        kept = filled | needs_empty[of]
        key = sums[kept] + W.mix((place[kept] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + group[of[kept]].astype(np.uint64))
        owners.append(of[kept])
        found.append((W.mix(key) >> np.uint64(16)).view(np.int64))
    return np.concatenate(owners), np.concatenate(found)


def _small_signatures(sets: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Owners and signatures of sets of up to ``SMALL`` elements: all elements, all but one."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = sizes[owner] <= SMALL
    owner, values = owner[inside], W.mix(sets[inside] ^ np.uint64(0xD1B54A32D192ED03))
    sums = np.zeros(len(sizes), np.uint64)
    np.add.at(sums, owner, values)
    whole = np.flatnonzero((sizes > 0) & (sizes <= SMALL))
    part = sizes[owner] >= LEAST
    owner, less = owner[part], (sums[owner] - values)[part]
    return [whole, owner], [(W.mix(x) >> np.uint64(16)).view(np.int64) for x in (sums[whole], less)]


def sketch_bits(size: int) -> int:
    """Bits of a parity sketch: some four times the elements that linked sets can differ in."""
    return 1 << max(7, min(16, (8 * size // 9).bit_length()))


def parity_sketch(own: np.ndarray) -> bytes:
    """Bit i is the parity of the elements that fall on i: two sketches differ in no more bits than the sets in elements."""
    bits = sketch_bits(len(own))
    odd = np.bincount((W.mix(own ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    out = np.frombuffer(sketch, np.uint8)
    while len(out) > size:  # position modulo half the bits
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def may_link(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """False only where the sketches prove that the sets differ in too many elements."""
    size = min(len(a), len(b))
    return 9 * int(_ONES[folded(a, size) ^ folded(b, size)].sum()) <= n_a + n_b and 5 * min(n_a, n_b) >= 4 * max(n_a, n_b)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))


def describe(docs: DataFrame) -> DataFrame:
    """doc, n, two hashes of the set and its parity sketch for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets, ends = shingle_sets(part.column(1))
                one, two = np.zeros((2, len(part)), np.uint64)
                owner = np.repeat(np.arange(len(part)), np.diff(ends))
                np.add.at(one, owner, W.mix(sets))
                np.add.at(two, owner, W.mix(sets ^ np.uint64(0xA0761D6478BD642F)))
                sketches = [parity_sketch(sets[a:b]) if b > a else b"" for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(sketches, pa.binary())],
                    ["doc", "n", "h1", "h2", "sketch"],
                )

    return _rows(docs).mapInArrow(run, "doc long, n long, h1 long, h2 long, sketch binary")


def signature_rows(docs: DataFrame) -> DataFrame:
    """sig and doc for every signature of sets that may link with others; of equal sets that one task sees only the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at in range(0, len(batch), 256):
                sets, ends = shingle_sets(batch.column(1).slice(at, 256))
                owner, sig = signatures(sets, ends)
                whole = np.zeros(len(ends) - 1, np.uint64)
                np.add.at(whole, np.repeat(np.arange(len(whole)), np.diff(ends)), W.mix(sets))
                new = np.zeros(len(whole), bool)
                for k, h in enumerate(whole.tolist()):
                    if h not in seen:
                        seen.add(h)
                        new[k] = True
                kept = (new & (np.diff(ends) >= LEAST))[owner]  # smaller sets link only with equal ones, which are one class
                yield pa.RecordBatch.from_arrays([pa.array(sig[kept]), pa.array(ids[at : at + 256][owner[kept]])], ["sig", "doc"])

    return _rows(docs).mapInArrow(run, "sig long, doc long")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, h1, h2 and the set of the documents wanted, picked with a sieve of bounded size."""
    spark = docs.sparkSession
    bits = bits_for(wanted.count(), MOST_BITS)
    slot = F.pmod(F.xxhash64("doc"), F.lit(bits))
    shared = spark.sparkContext.broadcast(sieve_of(wanted, slot, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            slot = batch.column(2).to_numpy()
            batch = batch.filter(pa.array(passes(sieve, slot)))
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets, ends = shingle_sets(part.column(1))
                one, two = np.zeros((2, len(part)), np.uint64)
                owner = np.repeat(np.arange(len(part)), np.diff(ends))
                np.add.at(one, owner, W.mix(sets))
                np.add.at(two, owner, W.mix(sets ^ np.uint64(0xA0761D6478BD642F)))
                blobs = [sets[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(blobs, pa.binary())], ["doc", "h1", "h2", "elements"]
                )

    rows = _rows(docs).select("doc", "text", slot.alias("slot"))
    return rows.mapInArrow(run, "doc long, h1 long, h2 long, elements binary")


def verified(docs: DataFrame, pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those pairs (a, b) of representatives whose sets link, counted in full."""
    wanted = held(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "wanted")
    exact = known.join(wanted, "doc", "left_semi").select("doc", "h1", "h2")
    sets = held(sets_of(docs, wanted).join(exact, ["doc", "h1", "h2"], "left_semi").dropDuplicates(["doc"]).select("doc", "elements"), "sets")
    one = sets.select(F.col("doc").alias("a"), F.col("elements").alias("of_a"))
    two = sets.select(F.col("doc").alias("b"), F.col("elements").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                kept.append(100 * shared >= 80 * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _plausible(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs that the sketches do not rule out."""
    one = known.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = known.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(2, 6)]
            kept = [may_link(s, t, n, m) for n, s, m, t in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.join(one, "a").join(two, "b").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    return joined.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(run, "a long, b long")


def _across(members: DataFrame) -> DataFrame:
    """Plausible pairs of one signature and different labels, from blocks of its members."""
    order = Window.partitionBy("sig").orderBy("doc")
    numbered = members.withColumns(
        {"block": F.floor((F.row_number().over(order) - 1) / GROUP).cast("int"), "size": F.count("*").over(Window.partitionBy("sig"))}
    )
    met = numbered.select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / GROUP).cast("int"))).alias("other")
    ).select("sig", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc", "n", "label", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n < CHUNK_ROWS:
                continue
            rows = pa.Table.from_batches(waiting)
            sig, low, high = (rows.column(c).to_numpy() for c in ("sig", "low", "high"))
            last = (sig == sig[-1]) & (low == low[-1]) & (high == high[-1])  # this group may go on
            cut = int(np.argmax(last))
            if cut:
                yield plausible_pairs(rows.slice(0, cut))
                waiting, n = rows.slice(cut).to_batches(), len(rows) - cut
        if n:
            yield plausible_pairs(pa.Table.from_batches(waiting))

    dealt = met.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high", "block", "doc")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def plausible_pairs(rows: pa.Table) -> pa.RecordBatch:
    """Pairs within the groups of rows (sorted by group) that differ in label and that sizes and sketches allow.

    In a group of one block all rows meet, in a group of two the rows of one block those of
    the other. Pairs are made a distance in the order at a time, for all groups together.
    """
    sig, low, high, block, doc, n, label = (rows.column(c).to_numpy() for c in ("sig", "low", "high", "block", "doc", "n", "label"))
    total = len(sig)
    new = np.ones(total, bool)
    new[1:] = (sig[1:] != sig[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    first = np.flatnonzero(new)
    end = np.repeat(np.append(first[1:], total), np.diff(np.append(first, total)))
    sketches = rows.column("sketch").to_pylist()
    sizes = np.fromiter(map(len, sketches), np.int64, total)
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in np.unique(sizes).tolist():
        use = np.flatnonzero(sizes >= size)
        place = np.zeros(total, np.int64)
        place[use] = np.arange(len(use))
        tables[size] = (place, np.stack([folded(sketches[k], size) for k in use.tolist()]).view(np.uint64))
    found = [np.zeros((0, 2), np.int64)]
    active, apart = np.arange(total), 0
    while len(active):
        apart += 1
        active = active[active + apart < end[active]]
        i, j = active, active + apart
        open_ = (label[i] != label[j]) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
        open_ &= (low[i] == high[i]) | (block[i] != block[j])
        i, j = i[open_], j[open_]
        least = np.minimum(sizes[i], sizes[j])
        for size in np.unique(least).tolist():
            place, bits = tables[size]
            own = least == size
            p, q = i[own], j[own]
            for at in range(0, len(p), 65536):
                x, y = p[at : at + 65536], q[at : at + 65536]
                far = np.bitwise_count(bits[place[x]] ^ bits[place[y]]).sum(axis=1, dtype=np.int64)
                kept = 9 * far <= n[x] + n[y]
                found.append(np.stack([np.minimum(doc[x], doc[y])[kept], np.maximum(doc[x], doc[y])[kept]], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def classes(docs: DataFrame) -> DataFrame:
    """doc (sortable id), n and component for every row of ``docs``.

    Documents link when the Jaccard similarity of their word-5-gram sets is 0.8 or more; a
    component is all that links reach. Equal sets are one representative, the smallest id.
    Every linked pair of representatives shares a signature; sets of fewer than four
    elements link only with equal ones and have none. In each signature's group all
    are first held against the smallest member; after that, pairs of the group that are not
    yet connected are held against each other. Parity sketches drop pairs that provably
    differ too much; whatever they leave is counted exactly, so no link is lost, and no
    more pairs are made than are still open.

    A null or blank text has an empty set and links with nothing. A null id counts as one
    document before all others. Rows that share an id are one document, whose links are
    those of all its texts.
    """
    ship_package(docs.sparkSession)
    rows = held(describe(docs), "sets-described")
    filled = rows.filter("n > 0")
    firsts = filled.groupBy("h1", "h2").agg(F.min("doc").alias("rep"))
    class_of = held(filled.select("doc", "h1", "h2").distinct().join(firsts, ["h1", "h2"]), "classes")
    own = filled.join(class_of.filter("doc = rep").select("doc", "h1", "h2"), ["doc", "h1", "h2"], "left_semi")
    known = held(own.dropDuplicates(["doc"]), "representatives")
    reps = class_of.select("doc", "rep").distinct()
    # ids with several texts tie their classes together
    ties = reps.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z").drop("z")
    tied = ties.join(reps, "doc").filter("a <> rep").select("a", F.col("rep").alias("b"))

    by_sig = Window.partitionBy("sig")
    grouped = signature_rows(docs).withColumns({"low": F.min("doc").over(by_sig), "top": F.max("doc").over(by_sig)})
    open_groups = grouped.filter("low <> top").select("sig", "doc")
    members = held(open_groups.join(reps, "doc").select("sig", F.col("rep").alias("doc")).distinct(), "members")
    pivots = members.withColumn("a", F.min("doc").over(by_sig)).filter("a <> doc").select("a", F.col("doc").alias("b")).distinct()
    first = held(_plausible(pivots, known).groupBy("b").agg(F.min("a").alias("a")), "pairs")
    links = held(verified(docs, first.select("a", "b"), known).union(tied), "links")
    labels = held(components(links), "labelled")
    # what the first round left open, one pair for each two components, then the rest
    for last in (False, True):
        if not last:
            named = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
            mixed = named.withColumns({"l1": F.min("label").over(by_sig), "l2": F.max("label").over(by_sig)}).filter("l1 <> l2").drop("l1", "l2")
            left = held(_across(mixed.join(known.select("doc", "n", "sketch"), "doc")).join(first.select("a", "b"), ["a", "b"], "left_anti"), "open")
        ends = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        apart = left.join(ends, "a", "left").join(ends.select(F.col("a").alias("b"), F.col("la").alias("lb")), "b", "left")
        apart = apart.withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).filter("la <> lb")
        if not last:
            sides = apart.withColumns({"lo": F.least("la", "lb"), "hi": F.greatest("la", "lb")})
            chosen = sides.groupBy("lo", "hi").agg(F.min(F.struct("a", "b", "la", "lb")).alias("p")).select("p.*")
        else:
            chosen = apart
        chosen = held(chosen.select("a", "b", "la", "lb"), "pairs")
        if chosen.isEmpty():
            break
        # only the components that the new links join are named anew
        met = verified(docs, chosen.select("a", "b"), known).join(chosen, ["a", "b"]).select(F.col("la").alias("a"), F.col("lb").alias("b"))
        moved = components(met)
        ends = chosen.select(F.explode(F.array("la", "lb")).alias("node")).distinct()
        every = labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
        after = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = held(every.join(after, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labelled")
    of_rep = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("doc", F.coalesce("label", "rep").alias("label"))
    of_doc = of_rep.groupBy("doc").agg(F.min("label").alias("label"))
    return rows.select("doc", "n").join(of_doc, "doc", "left").select("doc", "n", F.coalesce("label", "doc").alias("component"))
