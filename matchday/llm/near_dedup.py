"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct shingles of ``words`` words (U+0020 and U+0009 to U+000D split words, A-Z lower-cased); with
fewer words the whole sequence is its only shingle; without words it is empty and like nothing. Documents with a Jaccard
similarity of ``percent`` or more are linked; components of links are the groups, named by their smallest doc_id.

Documents with equal sets are one class. A class has a SetSketch: register i is floor(1 - log_b x), where x is the smallest
of exponentially distributed hashes of the shingles, so registers are exponentially spaced and truncated minima: sketches merge by
taking the larger register, and two registers are equal about as often as the sets are similar. Classes with all registers of a
band equal are candidates. The similarity of a pair is estimated by maximum likelihood from the numbers of larger, smaller and
equal registers and the two set sizes; pairs whose estimate is not far below the limit are verified on the full sets.

Candidates of a bucket are not all paired. In a few rounds over more and more bands, one member of every component that a bucket
holds is paired with that of its smallest; the verified links give the components of the next round. Then, in buckets that still hold
several components, members outside the most frequent one are compared with all members, a block of these with a block of those: by
their registers first, and what looks similar on the full sets, which travel with the blocks. Members of one component need no link,
so a task returns at most one link for every two components that it joins. Buckets with the same members are looked at once.

With 32 bands of 4 registers a pair at 80 % is missed by all bands with probability (1 - 0.8^4)^32 = 5e-8, and by an estimate 4
standard deviations too low with 3e-5. Rows of one doc_id are one document. A NULL text is empty.
Rows with a NULL doc_id are groups of their own if their text is empty, else in the group of their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import forget_words, mixed, only, stored, word_hashes
from matchday.llm.components import connected

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base, rate and truncation of the registers.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
#: Estimates this much below the limit are still verified: four standard deviations.
SLACK = 0.14
#: Bands looked at in each of the first rounds.
ROUNDS = (4, 8, 20)
#: Bytes of registers and shingles of the members of a bucket in one block; what one member has besides its shingles.
BLOCK_BYTES, MEMBER_BYTES = 8_000_000, 500
#: Pairs that are compared at once in a task.
CELLS = 65_536

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_PLACES = _random.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < words:
        return np.array([xxhash.xxh64_intdigest(w.tobytes(), seed=len(w))], dtype=np.uint64)
    n = len(w) - words + 1
    total = w[:n] * _PLACES[0]
    for i in range(1, words):
        total += w[i:i + n] * _PLACES[i % 16] + np.uint64(i)
    return np.unique(mixed(total))


def registers_of(sets: list[np.ndarray], chunk: int = 65_536) -> np.ndarray:
    """Registers of non-empty sets, one row each."""
    smallest = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    at = 0
    while at < len(sets):
        upto, size = at, 0
        while upto < len(sets) and (upto == at or size + len(sets[upto]) <= chunk):
            size += len(sets[upto])
            upto += 1
        flat = np.concatenate(sets[at:upto])
        starts = np.cumsum([0, *map(len, sets[at:upto - 1])])
        hashed = np.empty_like(flat)
        for i in range(REGISTERS):
            np.multiply(flat, _FACTORS[i], out=hashed)
            np.add(hashed, _SHIFTS[i], out=hashed)
            smallest[at:upto, i] = np.minimum.reduceat(hashed, starts)
        at = upto
    u = (smallest.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(u, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def likely_similarity(larger, smaller, n_left, n_right) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the numbers of registers larger and smaller on the left."""
    larger, smaller = np.asarray(larger, float), np.asarray(smaller, float)
    equal = REGISTERS - larger - smaller
    u = np.asarray(n_left, float) / (np.asarray(n_left, float) + n_right)
    v = 1 - u

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        more, less = np.maximum(share(u - v * j), 1e-12), np.maximum(share(v - u * j), 1e-12)
        return larger * np.log(more) + smaller * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(a) < likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def _sketches(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start:start + 500]
                sets = [shingle_set(t, words) for t in part["text"]]
                full = [i for i, s in enumerate(sets) if len(s)]
                found = registers_of([sets[i] for i in full]) if full else []
                node, registers = [None] * len(sets), [None] * len(sets)
                for row, i in enumerate(full):
                    node[i] = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(sets[i].tobytes()))))
                    registers[i] = found[row].tobytes()
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
                                    "node": pd.array(node, dtype="Int64"), "registers": registers})
        forget_words()

    return run


def _band_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        r = np.frombuffer(b"".join(batch["registers"]), dtype="<u2").reshape(len(batch), BANDS, ROWS).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
        for i in range(ROWS):
            key = mixed(key * _PLACES[i] + r[:, :, i])
        yield pd.DataFrame({"band": np.tile(np.arange(BANDS, dtype=np.int32), len(batch)), "key": key.view(np.int64).ravel(),
                            "node": np.repeat(batch["node"].to_numpy(np.int64), BANDS)})


def _estimated(limit: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a = np.frombuffer(b"".join(batch["ra"]), dtype="<u2").reshape(-1, REGISTERS)
            b = np.frombuffer(b"".join(batch["rb"]), dtype="<u2").reshape(-1, REGISTERS)
            j = likely_similarity((a > b).sum(1), (a < b).sum(1), batch["na"].to_numpy(), batch["nb"].to_numpy())
            yield batch.loc[j >= limit, ["a", "b"]]

    return run


def low_bits(registers: np.ndarray) -> np.ndarray:
    """The lowest bit of each register, 64 to a word: unequal registers agree in it half of the time."""
    return np.packbits((registers & 1).astype(np.uint8), axis=1).view(np.uint64)


def most_unequal_bits(similarity: float) -> int:
    """Low bits in which a pair of this similarity may differ: five standard deviations above the mean."""
    share = (1 - similarity) / 2
    return int(np.ceil(REGISTERS * share + 5 * np.sqrt(REGISTERS * share * (1 - share))))


def are_similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two full sets, sorted, have ``percent`` of their union in common."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compared(limit: float, percent: int):
    """Links between the components of a group of blocks: a stray and a member each, verified on their full sets.

    Most pairs are told apart by the low bits of their registers, most others by all of the registers; the likeliest are verified
    first, and none whose components a verified link has joined already."""
    most = most_unequal_bits(limit + SLACK)

    def run(members: pd.DataFrame, strays: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        if len(members) and len(strays):
            members = members.sort_values("unit", kind="stable")
            strays = strays.sort_values("of", kind="stable")
            m, s = (np.frombuffer(b"".join(f["registers"]), dtype="<u2").reshape(-1, REGISTERS) for f in (members, strays))
            m_bits, s_bits = low_bits(m), low_bits(s)
            m_id, m_label, m_size, m_set = (members[c].to_numpy() for c in ("node", "label", "n", "shingles"))
            s_id, s_label, s_size, s_set = (strays[c].to_numpy() for c in ("node", "label", "n", "shingles"))
            root: dict[int, int] = {}
            tried: set[tuple[int, int]] = set()
            waiting, held = [], 0

            def top(label: int) -> int:
                while (up := root.get(label, label)) != label:
                    root[label] = root.get(up, up)
                    label = up
                return label

            def settle() -> None:  # many pairs at a time, as most blocks are small
                x, y = (np.concatenate([pair[i] for pair in waiting] or [np.empty(0, np.int64)]) for i in (0, 1))
                waiting.clear()
                j = likely_similarity((s[x] > m[y]).sum(1), (s[x] < m[y]).sum(1), s_size[x], m_size[y])
                for i in np.argsort(-j, kind="stable")[:int((j >= limit).sum())]:
                    u, v = x[i], y[i]
                    pair = (min(s_id[u], m_id[v]), max(s_id[u], m_id[v]))
                    one, two = top(s_label[u]), top(m_label[v])
                    if one != two and pair not in tried:
                        tried.add(pair)
                        if are_similar(np.frombuffer(s_set[u], "<u8"), np.frombuffer(m_set[v], "<u8"), percent):
                            root[max(one, two)] = min(one, two)
                            links.append(pair)

            units = members["unit"].to_numpy()
            starts = np.flatnonzero(np.append(True, units[1:] != units[:-1]))
            block_of = {units[at]: (at, end) for at, end in zip(starts, np.append(starts[1:], len(units)))}
            units = strays["of"].to_numpy()
            starts = np.flatnonzero(np.append(True, units[1:] != units[:-1]))
            for first, last in zip(starts, np.append(starts[1:], len(units))):
                at, end = block_of.get(units[first], (0, 0))
                step = max(CELLS // max(end - at, 1), 1)
                for start in range(first, last if end > at else first, step):
                    upto = min(start + step, last)
                    unequal = np.zeros((upto - start, end - at), dtype=np.uint8)
                    for word in range(s_bits.shape[1]):
                        unequal += np.bitwise_count(s_bits[start:upto, word, None] ^ m_bits[None, at:end, word])
                    x, y = np.nonzero(unequal <= most)
                    x, y = x + start, y + at
                    other = s_label[x] != m_label[y]
                    x, y = x[other], y[other]
                    equal = (s[x] == m[y]).sum(1)
                    near = equal >= (limit - 0.1) * REGISTERS
                    waiting.append((x[near], y[near]))
                    held += int(near.sum())
                    if held >= CELLS:
                        settle()
                        held = 0
            settle()
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return run


def _similar(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [are_similar(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"), percent)
                    for x, y in zip(batch["sa"], batch["sb"])]
            yield batch.loc[np.array(good, dtype=bool), ["a", "b"]].rename(columns={"a": "u", "b": "v"})

    return run


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start:start + 500]
                yield pd.DataFrame({"node": part["node"], "shingles": [
                    shingle_set(t, words).astype("<u8").tobytes() for t in part["text"]]})
        forget_words()

    return run


def _sets_of(docs: DataFrame, nodes: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``(node, shingles)`` of distinct ``nodes``, from one document of each class; rows of one id hold one text."""
    wanted = stored(classes.join(nodes, "node", "left_semi").select(F.col("low").alias("doc_id"), "node"), "wanted")
    count = wanted.count()
    texts = docs.select("doc_id", "text").join(
        F.broadcast(wanted) if count <= 2_000_000 else wanted.hint("shuffle_merge"), "doc_id")
    return stored(texts.mapInPandas(_sets(words), "node long, shingles binary").dropDuplicates(["node"]), "sets")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(u, v)`` among ``pairs`` (``a``, ``b``), decided on the full sets."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(docs, nodes, classes, words)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInPandas(_similar(percent), "u long, v long")


def _named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``(key, node, label)``: members of buckets with their component, by default the node itself."""
    if labels is None:
        return members.select("key", "node", F.col("node").alias("label"))
    return members.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))


def _linked_heads(docs: DataFrame, members: DataFrame, labels: DataFrame | None, classes: DataFrame, words: int, percent: int,
                  limit: float) -> DataFrame:
    """Verified links between one member of each component in a bucket and that of the bucket's smallest."""
    firsts = stored(_named(members, labels).groupBy("key", "label").agg(F.min("node").alias("node")), "firsts")
    heads = firsts.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    pairs = firsts.join(heads, "key").filter("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("registers").alias(f"r{side}"),
                                          F.col("n").alias(f"n{side}")), side)
    likely = stored(pairs.select("a", "b", "ra", "rb", "na", "nb").mapInPandas(_estimated(limit), "a long, b long"), "pairs")
    return stored(_verified(docs, likely, classes, words, percent), "links")


def _linked_strays(docs: DataFrame, members: DataFrame, labels: DataFrame | None, classes: DataFrame, words: int, percent: int,
                   limit: float) -> DataFrame | None:
    """Verified links within the buckets that hold several components; None if there is no such bucket."""
    named = stored(_named(members, labels), "named")
    size = F.col("n") * 8 + MEMBER_BYTES
    per_label = named.join(classes.select("node", "n"), "node").groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("held"), F.sum(size).alias("bytes"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"))
    per_key = per_label.groupBy("key").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("held").alias("held"), F.sum("h1").alias("h1"), F.bit_xor("h2").alias("h2"),
        F.sum("bytes").alias("bytes"), F.max(F.struct("held", "label", "bytes")).alias("most")).filter("labels > 1")
    # Buckets of the same members, told by two 64-bit sums over them, are one.
    open_keys = stored(per_key.groupBy("held", "h1", "h2").agg(F.min("key").alias("key"), F.first("bytes").alias("bytes"),
                                                              F.first("most").alias("most")).select(
        "key", F.expr("most.label").alias("main"), F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks"),
        F.ceil((F.col("bytes") - F.expr("most.bytes")) / BLOCK_BYTES).cast("int").alias("pieces")), "open-buckets")
    held = stored(named.join(open_keys, "key"), "open-members")
    nodes = held.select("node").distinct()
    sets = _sets_of(docs, nodes, classes, words)
    rows = held.join(classes.select("node", "n", "registers"), "node").join(sets, "node")
    total = held.join(classes.select("node", "n"), "node").agg(
        F.sum(size * (F.col("pieces") + F.when(F.col("label") != F.col("main"), F.col("blocks")).otherwise(0)))).first()[0]
    if not total:
        return None
    # Blocks are dealt to groups of a few blocks' size, as most buckets are small.
    groups = F.lit(int(total // BLOCK_BYTES) + 15)
    columns = ["node", "label", "n", "registers", "shingles"]

    def dealt(df: DataFrame, block, piece, unit: str, group: str) -> DataFrame:
        at = df.select("key", *columns, block.alias("__block"), piece.alias("__piece"))
        unit_of = F.xxhash64("key", "__block", "__piece")
        return at.select(*[F.col(c).alias(c) for c in columns], unit_of.alias(unit), F.pmod(F.xxhash64("key", "__block", "__piece", F.lit(7)), groups).alias(group))

    own = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    blocks = dealt(rows, own("blocks"), every("pieces"), "unit", "slot")
    strays = dealt(rows.filter("label <> main"), every("blocks"), own("pieces"), "of", "at")
    return stored(blocks.groupBy("slot").cogroup(strays.groupBy("at")).applyInPandas(
        _compared(limit, percent), "u long, v long").distinct(), "links")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs`` (``doc_id``, ``text``)."""
    limit = percent / 100 - SLACK
    sketched = stored(docs.select("doc_id", "text").mapInPandas(
        _sketches(words), "doc_id long, n_shingles long, node long, registers binary"), "sketches")
    classes = stored(sketched.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("low"), F.max("n_shingles").alias("n"), F.first("registers").alias("registers")), "classes")
    members = stored(classes.select("node", "registers").mapInPandas(_band_keys, "band int, key long, node long"), "bands")
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("key")
    members = stored(members.join(buckets, "key"), "members")

    labels, links, upto = None, None, 0
    for bands in ROUNDS:
        some = members.filter(F.col("band").between(upto, upto + bands - 1))
        upto += bands
        found = _linked_heads(docs, some, labels, classes, words, percent, limit)
        links = found if links is None else links.unionByName(found)
        labels = stored(connected(links), "labels")
    more = _linked_strays(docs, members, labels, classes, words, percent, limit)
    if more is not None and not more.isEmpty():
        labels = stored(connected(links.unionByName(more)), "labels")

    named_low = classes.select("node", "low").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lows = named_low.groupBy("label").agg(F.min("low").alias("component_id"))
    found = stored(named_low.join(lows, "label").select(F.col("node").alias("class"), "component_id"), "components")
    full = sketched.filter("node is not null").select("doc_id", "n_shingles", "node").join(
        found, F.col("node") == F.col("class")).select("doc_id", "n_shingles", "component_id")
    empty = sketched.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, all columns as they are."""
    gone = stored(near_groups(docs, words, percent).filter(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    return only(docs, gone, "doc_id", "left_anti").select(*docs.columns)
