"""Near-duplicate groups by HyperMinHash: compressed registers in bands, candidates in the order of their estimated
similarity, links confirmed on full shingle sets.

Documents with equal sets are one class from the start. Classes meet in buckets of equal bands. In each bucket all classes
have its hub as a candidate, the class that shares most buckets with others. A class's best candidate by the collision-
corrected estimate is confirmed first; candidates that are then in one group already are never looked at again. Buckets
whose classes are still apart are searched in full: small ones as pairs. Classes of larger ones meet by the rarest shingles
of their sets, of which two linked sets share one at least. No large bucket's pairs are written out, and no bucket is cut.
Before texts move, sketches tell which pairs differ in too many shingles to be linked: a bound, so no link is lost. Texts
are read from the documents at each step that needs some of them; of texts, registers, sketches and bands only those move
that a table of bits tells to be wanted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm import shingles as S
from tidewire.llm.common import Hot, among, hot_keys, mapped, salted_join, ship, text_bytes, written
from tidewire.llm.components import components

#: Pairs of one hub checked in one group; classes of a bucket or shingle that is searched as pairs; classes in one block of a larger one.
CHUNK, SMALL, BLOCK = 256, 48, 1024
#: Counters of the sketch that orders shingles, and texts whose shingles a task holds at once.
COUNTERS, PART = 1 << 20, 512
_LAST = 9223372036854775807


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            yield batch.slice(i, PART)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, digest, registers, sketch): size and digest of each document's shingle set, its registers and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            value, offsets = S.shingle_sets(*text_bytes(part.column(1)))
            made = S.registers(value, offsets)
            digests = [S.set_digest(value[a:b]) if b > a else None for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(digests, pa.binary()),
                    pa.array([r.tobytes() for r in made], pa.binary()),
                    pa.array(S.sketches(value, offsets), pa.binary()),
                ],
                names=["id", "n", "digest", "registers", "sketch"],
            )

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), F.col(text).cast("string").alias("t"))
    return mapped(rows, run, "id long, n long, digest binary, registers binary, sketch binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """(id, n, key): a row for each class and band with a filled register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, keys = S.band_keys(_registers(batch.column(2)))
            at = pa.array(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(keys)], names=["id", "n", "key"])

    return mapped(classes.select("id", "n", "registers"), run, "id long, n long, key long")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), S.REGISTERS)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))


def _beside(pairs: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs (a, b, ...) with columns (_c_a, _c_b) of both classes."""
    classes = among(classes.select("id", *columns), "id", _ends(pairs))
    of_a, of_b = (classes.select(F.col("id").alias(s), *(F.col(c).alias(f"_{c}_{s}") for c in columns)) for s in "ab")
    hot = hot_keys(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_pairs")), ["b"], "_pairs")
    return salted_join(pairs.join(of_a, "a"), of_b, ["b"], F.col("a"), hot)


def _may_link(batch: pa.RecordBatch) -> pa.Array:
    both = (zip(*(batch.column(f"_{c}_{s}").to_pylist() for s in "ab"), strict=True) for c in ("sketch", "n"))
    return pa.array([bool(S.may_link(S.unlike(*sketches), *n)) for sketches, n in zip(*both, strict=True)], pa.bool_())


def linkable(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that may be linked, told by the sketches of both: a bound that drops no link."""
    columns = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(columns).filter(_may_link(batch))

    return mapped(_beside(pairs, classes, ["n", "sketch"]), run, pairs.schema)


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``linkable`` of the pairs (a, b, ...) with ``estimate``: the similarity that the registers tell, less expected collisions."""
    columns = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(_may_link(batch))
            if not batch.num_rows:
                continue
            left, right = (_registers(batch.column(f"_registers_{s}")) for s in "ab")
            sizes = (batch.column(f"_n_{s}").to_numpy() for s in "ab")
            found = S.jaccard_of(left, right, *sizes)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found)], names=[*columns, "estimate"])

    met = _beside(pairs, classes, ["n", "registers", "sketch"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return mapped(met, run, f"{fields}, estimate double")


def _sets(texts: pa.Array) -> list[np.ndarray]:
    value, offsets = S.shingle_sets(*text_bytes(texts))
    return [value[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked.

    A hub's pairs are dealt out in parts of about CHUNK, each with a copy of its text in front; a text moves once to be
    found and once to its part.
    """
    hubs = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    members = salted_join(pairs, hubs, ["b"], F.col("a"), hot_keys(hubs.withColumn("n", F.col("parts") * CHUNK), ["b"], "n")).select(
        F.col("a").alias("id"), "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role")
    )
    centres = hubs.select(
        F.col("b").alias("id"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role")
    )
    wanted = among(texts, "id", _ends(pairs))
    placed = members.union(centres).join(wanted, "id").repartition("b", "part").sortWithinPartitions("b", "part", "role")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, centre = None, []
        for rows in _parts(batches):
            found = []
            columns = [rows.column(c).to_pylist() for c in ("id", "b", "part", "role")]
            for own_id, hub_id, part, role, own in zip(*columns, _sets(rows.column("t")), strict=True):
                if here != (hub_id, part):
                    here, centre = (hub_id, part), []
                if not role:
                    centre.append(own)
                elif any(S.linked(len(np.intersect1d(own, hub, assume_unique=True)), len(own), len(hub)) for hub in centre):
                    found.append((own_id, hub_id))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return mapped(placed.select("id", "b", "part", "role", "t"), check, "a long, b long")


def block_links(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between classes of different labels, enough to join all that are joined: rows ``left`` against rows ``right``.

    A pair with similarity 0.75 shares at least 3/7 of its two sizes; a class with fewer shingles that occur elsewhere has
    no partner of that size.
    """
    size = np.array([len(s) for s in sets], np.int64)
    value = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    fresh = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    ends = np.append(fresh[1:], len(value))
    spread = np.repeat(ends - fresh, ends - fresh)
    common = np.bincount(owner, weights=spread > 1, minlength=len(sets))
    group = {x: x for x in np.unique(labels).tolist()}

    def root(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    usable = np.zeros(len(sets), bool)
    usable[right] = True
    out, unique = [], value[fresh]
    names, counts = np.unique(labels[right], return_counts=True)
    largest = names[np.argmax(counts)] if len(names) else None
    own = set(left.tolist()) == set(right.tolist())
    for i in left:
        if own and labels[i] == largest:
            continue  # all that is left out here is tried from the other side
        least = np.maximum(size, np.ceil(0.75 * size[i]))
        maybe = usable & (100 * common[i] >= 75 * (size[i] + least - common[i])) & (4 * size >= 3 * size[i]) & (3 * size <= 4 * size[i])
        maybe &= labels != labels[i]
        if not maybe.any():
            continue
        at = np.searchsorted(unique, sets[i])
        hits = np.concatenate([owner[fresh[k] : ends[k]] for k in at]) if len(at) else at
        inter = np.bincount(hits, minlength=len(sets))
        for j in np.flatnonzero(maybe & S.linked(inter, size[i], size)):
            a, b = root(int(labels[i])), root(int(labels[j]))
            if a != b:
                group[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
    return out


def may_meet(sketches: list[bytes], n: np.ndarray, labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows may be linked with one of another label, rows ``left`` against rows ``right``, as their sketches tell.

    Sizes of linked sets are within a third of each other, so one sketch has the other's length or twice that.
    """
    length, stays = np.array([len(s) for s in sketches], np.int64), np.zeros(len(sketches), bool)
    names, counts = np.unique(labels, return_counts=True)
    largest = names[np.argmax(counts)] if len(names) else None
    for size in np.unique(length):
        of_size = (length == size) | (length == 2 * size)
        for mine, met in ((left, right), (right, left)):
            # Of two labels one is not the most frequent; rows of that one are found from the other side.
            rows, others = np.flatnonzero(mine & of_size & (labels != largest)), np.flatnonzero(met & of_size)
            if not len(rows) or not len(others):
                continue
            cells = np.stack([S.folded(sketches[j], size) for j in others])
            for i in rows:
                apart = np.bitwise_count(cells ^ S.folded(sketches[i], size)).sum(1, dtype=np.int64)
                found = others[(labels[others] != labels[i]) & S.may_link(apart, n[i], n[others]) & ((length[i] == size) | (length[others] == size))]
                stays[found] = True
                stays[i] |= len(found) > 0
    return stays


def _large_lists(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, label, own, lo, hi): the classes (key, id, label, m) of a shingle that many share even as one of their rarest.

    Blocks of such a list meet in pairs (lo, hi), each pair in one task. Where a class meets none of another label that its
    sketch lets it be linked with, its row is left out, before any text moves.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    dealt = (
        members.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "id", "label", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )

    def possible(rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi, own = rows["lo"].iloc[0], rows["hi"].iloc[0], rows["own"].to_numpy()
        stays = may_meet(rows["sketch"].tolist(), rows["n"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), own == lo, own == hi)
        return rows.loc[stays, ["key", "id", "label", "own", "lo", "hi"]]

    ship(members.sparkSession)
    sketches = among(classes.select("id", "n", "sketch"), "id", members.select("id"))
    return dealt.join(sketches, "id").groupBy("key", "lo", "hi").applyInPandas(possible, dealt.schema)


def _large_links(dealt: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the classes of each pair of blocks (key, lo, hi)."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.arange(len(rows))
        lo, hi = rows["lo"].iloc[0], rows["hi"].iloc[0]
        mine = rows["own"].to_numpy() == lo
        found = block_links(
            rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), _sets(pa.array(rows["t"], pa.string())), at[mine], at if lo == hi else at[~mine]
        )
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    ship(dealt.sparkSession)
    return dealt.join(among(texts, "id", dealt.select("id")), "id").groupBy("key", "lo", "hi").applyInPandas(search, "a long, b long")


def _prefixes(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, id, n, label): the rarest shingles of each class (id, n, label), so many that linked sets share one.

    Sets of a similarity of 0.75 or more share at least 0.75 of either one's shingles; so in any order of all shingles they
    share one of the first n - ceil(0.75 n) + 1. The order is by how often the classes hold a shingle, as a sketch of fixed
    size counts it: one that no other class can hold is left out, and common ones are seldom needed.
    """
    rows = members.join(among(texts, "id", members.select("id")), "id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for part in _parts(batches):
            for own in _sets(part.column(0)):
                np.add.at(total, _counter(own), 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])

    counts = mapped(rows.select("t"), counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    held_by = np.ones(COUNTERS, np.int64)
    held_by[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    often = members.sparkSession.sparkContext.broadcast(held_by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            out = []
            for own in _sets(part.column(3)):
                held = often.value[_counter(own)]
                first = np.lexsort((own, held))[: len(own) - -(-3 * len(own) // 4) + 1]
                out.append(own[first[held[first] > 1]])
            at = pa.array(np.repeat(np.arange(len(out)), [len(x) for x in out]))
            keys = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(part.column(c).take(at) for c in range(3))], names=["key", "id", "n", "label"])

    return mapped(rows.select("id", "n", "label", "t"), run, "key long, id long, n long, label long")


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)).astype(np.int64) & (COUNTERS - 1)


def _apart(members: DataFrame, hot: Hot) -> DataFrame:
    """The rows (key, id, label, ...) of keys that hold classes of several labels."""
    several = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    return salted_join(members, several, ["key"], F.col("id"), hot)


def _pairs(members: DataFrame) -> DataFrame:
    """(a, b): the pairs of classes of unlike labels within a key, of sizes that can be linked."""
    left, right = (members.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "label"))) for s in "ab")
    return (
        left.join(right, "key")
        .where("id_a < id_b AND label_a != label_b AND 4 * n_a >= 3 * n_b AND 4 * n_b >= 3 * n_a")
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    )


def _same_key(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows with one key and unlike texts; rows without a key have none."""
    several = signed.where(F.col("digest").isNotNull() & (F.col("id") != _LAST)).groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
    rows = signed.select("id", "digest").join(several.where("x < y").select("id"), "id", "left_semi").distinct()
    named = rows.join(classes.select("digest", F.col("id").alias("a")), "digest").select("id", "a")
    return named.join(named.groupBy("id").agg(F.min("a").alias("b")), "id").where("a != b").select("a", "b").distinct()


def _labels(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): classes of one label are in one group. A class goes to the least class it is linked to, and with that one on."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
    near = written(ids.join(own, "id", "left").select("id", F.least("id", F.coalesce("b", "id")).alias("label")), "labels")
    many = hot_keys(near.groupBy("label").agg(F.count(F.lit(1)).alias("n")), ["label"], "n")
    tops = near.select(F.col("id").alias("label"), F.col("label").alias("top"))
    jumped = salted_join(near, tops, ["label"], F.col("id"), many).select("id", F.col("top").alias("label"))
    return written(jumped, "labels", last=[near])


def _unlike(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose classes have unlike labels."""
    hot = hot_keys(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), ["b"], "n")
    of_a = pairs.join(labels.select(F.col("id").alias("a"), F.col("label").alias("x")), "a")
    both = salted_join(of_a, labels.select(F.col("id").alias("b"), F.col("label").alias("y")), ["b"], F.col("a"), hot)
    return both.where("x != y").select("a", "b")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept), one row out for each row in.

    Linked are documents whose sets of five-word shingles have a similarity of 0.75 or more; a component is named by its
    smallest key, which is kept. Null, empty and blank texts have no shingles and no links; whole texts of any length are
    read. Rows of one key are one document, whatever their texts: all that is linked with any of them is one component.
    Rows without a key stand for themselves but count as the last one, and none of them is kept in a group with others. An
    empty table gives no rows; other columns are not carried.
    """
    made = written(signatures(docs, key, text), "signatures")
    signed = written(made.select("id", "n", "digest"), "signed")
    counted = made.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("registers", "sketch"))
    )
    classes = written(counted, "classes", last=[made])
    bands = written(band_rows(classes), "bands")
    shared = written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared")
    hot = hot_keys(shared, ["key"], "m")
    kept = among(bands, "key", shared.select("key"))
    met = written(salted_join(kept, shared, ["key"], F.col("id"), hot), "met", last=[bands, shared])
    scores = met.groupBy("id").agg(F.sum("m").alias("score"))
    scored = met.join(scores, "id")
    hubs = scored.groupBy("key").agg(F.max(F.struct(F.col("score"), (-F.col("id")).alias("i"), "n")).alias("h"))
    hubs = hubs.select("key", (-F.col("h.i")).alias("b"), F.col("h.score").alias("top"), F.col("h.n").alias("n_b"))
    tried = (
        salted_join(met, hubs, ["key"], F.col("id"), hot)
        .where("id != b AND 4 * n >= 3 * n_b AND 4 * n_b >= 3 * n")  # sets of other sizes have no link
        .groupBy(F.col("id").alias("a"), "b")
        .agg(F.max("top").alias("top"))
    )
    tried = written(tried, "candidates")
    tried = written(estimated(tried, classes), "tried", last=[tried])
    classes = written(classes.drop("registers"), "classes", last=[classes])
    wanted = met.select("id").distinct()
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # The likeliest candidate of each class first; most others then need no look.
    order = F.struct("estimate", "top", (-F.col("b")).alias("i"))
    best = written(tried.groupBy("a").agg((-F.max(order)["i"]).alias("b")), "best")
    links = written(confirmed(best, texts), "links")
    labels = _labels(wanted, links)
    rest = tried.select("a", "b").join(best, ["a", "b"], "left_anti")
    rest = written(_unlike(rest, labels), "other-candidates", last=[best, labels])
    links = written(links.union(confirmed(rest, texts)), "more-links", last=[links, rest])
    labels = _labels(wanted, links)
    marked = written(met.join(labels, "id"), "marked", last=[met, labels])
    open_ = written(_apart(marked, hot), "open", last=[marked])
    large = written(open_.where(F.col("m") > SMALL).select("id", "n", "label").distinct(), "large")
    pairs, postings = _pairs(open_.where(F.col("m") <= SMALL)), []
    if not large.isEmpty():
        rarest = written(_prefixes(large, texts), "postings")
        sizes = rarest.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key", "m")
        sizes = written(sizes, "posting-sizes")
        postings = [written(salted_join(rarest, sizes, ["key"], F.col("id"), hot_keys(sizes, ["key"], "m")), "open-postings", last=[rarest, sizes])]
        pairs = pairs.union(_pairs(postings[0].where(F.col("m") <= SMALL)))
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(pairs.distinct().join(done, ["a", "b"], "left_anti"), "pairs", last=[tried, open_, large])
    pairs = written(linkable(pairs, classes), "linkable-pairs", last=[pairs])
    postings = [written(_large_lists(many.where(F.col("m") > SMALL), classes), "large-lists", last=[many]) for many in postings]
    classes = written(classes.drop("sketch"), "classes", last=[classes])
    found = links.union(confirmed(pairs, texts))
    for many in postings:
        found = found.union(_large_links(many, texts))
    links = written(found, "all-links", last=[links, pairs, *postings])
    groups = components(links.union(_same_key(signed, classes)), "groups")
    found = classes.join(groups.withColumnRenamed("node", "id"), "id", "left").select("digest", "copies", F.coalesce("component", "id").alias("_component"))
    found = written(found, "found", last=[links, classes])
    by_digest = hot_keys(found, ["digest"], "copies")
    joined = salted_join(signed.where("digest IS NOT NULL"), found.drop("copies"), ["digest"], F.col("id"), by_digest).select("id", "n", "_component")
    single = signed.where("digest IS NULL").select("id", "n", F.col("id").alias("_component"))
    return joined.union(single).select(
        F.nullif("id", F.lit(_LAST)).alias(key),
        F.col("n").alias("n_shingles"),
        F.nullif("_component", F.lit(_LAST)).alias("component_id"),
        (F.col("id") == F.col("_component")).alias("kept"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate group: that of the smallest key, of rows without a key only if the group has no other.

    Rows are grouped by their own texts, so rows of one key with unlike texts stay, and so do unlike rows without a key.
    Texts without words are in no group: of those, one row of each key stays, and every row without a key. Ties go to the
    smallest text digest, equal rows to any. Whole texts are compared; an empty table stays empty; all columns are kept.
    """
    own = "_row"
    while own in docs.columns:
        own += "_"
    rows = written(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
    marks = rows.select(F.col(own).alias("_row"), F.col(key).alias("_key"), F.md5(F.col(text)).alias("_digest"))
    found = near_groups(rows.select(F.col(own).alias("_row"), F.col(text).alias("_text")), "_row", "_text").join(marks, "_row")
    blank = (F.col("n_shingles") == 0) & F.col("_key").isNotNull()
    groups = found.groupBy(F.when(~blank, F.col("component_id")).alias("_group"), F.when(blank, F.col("_key")).alias("_blank"))
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_digest", "_row"))
    kept = written(groups.agg(first.alias("_first")).select(F.col("_first._row").alias(own)), "kept-rows")
    return rows.join(kept.hint("shuffle_hash"), own, "left_semi").drop(own)
