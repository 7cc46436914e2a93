"""A hierarchical Pitman-Yor language model over words, with Chinese-restaurant seating sampled by Gibbs.

Every word before another is a restaurant, as is the start of a text. They share one parent, the restaurant of all words, whose base is a model
of the word's bytes: restaurants of a byte's three predecessors (the farther two hashed), whose parents are those of one predecessor, whose parent
has none. Several chains are sampled at once. In a sweep the customers of each dish in each restaurant are seated anew, given the restaurant's
tables and the parent's probability of the dish after the sweep before; a dish's tables are its customers in the parent, where they are seated
likewise. A dish with one customer has one table. Seating is exact for the first twenty customers and goes in blocks of a tenth of those seated
beyond. Predictive probabilities are averages over the last states of the chains.

Counts cover all training documents and are Spark aggregates by word and by pair of words, told by 64-bit hashes of the words. A pair that is there
once and in no other document follows from its words, so only other pairs are kept. Figures of at most ``FREQUENT`` words are broadcast, those of
others are joined, so that no frequent word is a hot key; at most ``FREQUENT`` pairs are scored where they are read, all others meet the model in a
join by pair. The driver holds these, the byte model's cells and sums per chain.

A null text is empty: one end token. A null id hashes as the empty text. Repeated rows count and are scored each. Other columns are not read.
An empty table gives no rows. Without training documents every word is unknown.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import Prefix, mixed, pieces, stored, words

FREQUENT = 300_000
SAMPLES = 3
SWEEPS = 2
END = b"\n"
START = b" "
STRENGTH = 1.0
DISCOUNT = {"context": 0.8, "word": 0.6, "bytes": 0.5}
STOP = 256
FAR = 16
CELLS = (257 * FAR, 257)
CHAINS = range(SAMPLES)


def id_of(word: bytes) -> np.uint64:
    """The number that stands for a word."""
    return Prefix(np.frombuffer(word, np.uint8))(np.array([0]), np.array([len(word)]))[0]


class Tokens:
    """Of all tokens of some texts: their ids, those of the tokens before them, their rows; and the words' bytes, spans and places."""

    def __init__(self, column: pa.Array):
        self.raw, self.s, self.e, first = words(column)
        rows = np.arange(len(first) - 1)
        self.n = np.diff(first) + 1
        self.row = np.repeat(rows, self.n)
        self.place = np.arange(len(self.s)) + np.repeat(rows, self.n - 1)
        self.id = np.full(len(self.row), id_of(END))
        if len(self.s):
            self.id[self.place] = Prefix(self.raw)(self.s, self.e)
        self.before = np.empty_like(self.id)
        self.before[1:] = self.id[:-1]
        self.before[first[:-1] + rows] = id_of(START)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)


def signed(ids: np.ndarray) -> pa.Array:
    return pa.array(ids.view(np.int64))


def gathered(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    """The words of the given spans as a binary array."""
    size = e - s
    at = np.concatenate([[0], np.cumsum(size)])
    flat = raw[np.repeat(s - at[:-1], size) + np.arange(int(at[-1]))] if len(s) else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _words(batches):
    for batch in batches:
        for lo, hi in pieces(batch, "text", 2 << 20):
            t = Tokens(batch.column("text")[lo:hi])
            _, at, n = np.unique(t.id[t.place], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([gathered(t.raw, t.s[at], t.e[at]), pa.array(n, pa.int64())], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END, START], pa.binary()), pa.array([hi - lo, hi - lo], pa.int64())], names=["word", "n"])


def _pairs(batches):
    """Pairs of tokens of a piece with their number; 0 for those of held-out texts."""
    for batch in batches:
        for lo, hi in pieces(batch, "text", 2 << 20):
            t = Tokens(batch.column("text")[lo:hi])
            held = batch.column("held")[lo:hi].to_numpy(zero_copy_only=False)[t.row]
            _, at, n = np.unique(pair_keys(t.before, t.id) << np.uint64(1) | held, return_index=True, return_counts=True)
            # Rows of one context together take less in a shuffle.
            order = np.argsort(t.before[at])
            at, n = at[order], n[order]
            yield pa.RecordBatch.from_arrays([signed(t.before[at]), signed(t.id[at]), pa.array(np.where(held[at], 0, n))], names=["u", "w", "n"])


def seated(n: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables at which ``n`` customers of a dish sit, if a new table has weight ``mass`` and a seated customer 1 less the discounts."""
    tables = np.minimum(n, 1).astype(np.float64)
    act, i = np.flatnonzero(n > 1), 1
    while len(act):
        k = np.minimum(max(1, i // 10), n[act] - i)
        p = mass[act] / (mass[act] + np.maximum(i - discount * tables[act], 1e-9))
        tables[act] += rng.binomial(k.astype(np.int64), np.clip(p, 0, 1))
        i += max(1, i // 10)
        act = act[n[act] > i]
    return tables


def byte_cells(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte of the words and their stop: the word's number, its restaurant, its dish."""
    size = e - s + 1
    word = np.repeat(np.arange(len(s)), size)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = s[word] + place
    dish = np.where(place < (e - s)[word], raw[np.minimum(at, max(len(raw) - 1, 0))] if len(raw) else 0, STOP).astype(np.int64)

    def back(k):
        return np.where(place >= k, raw[np.maximum(at - k, 0)] if len(raw) else 0, STOP).astype(np.int64)

    far = (mixed((back(2) * 257 + back(3)).astype(np.uint64)) % np.uint64(FAR)).astype(np.int64)
    return word, back(1) * FAR + far, dish


def _spans(column: pa.Array):
    """Bytes and spans of a binary array."""
    column = column.cast(pa.large_binary())
    bounds, data = column.buffers()[1:]
    at = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at[:-1], at[1:]


def _cells(batches):
    total = np.zeros(CELLS[0] * CELLS[1], np.int64)
    for batch in batches:
        raw, s, e = _spans(batch.column("word"))
        _, room, dish = byte_cells(raw, s, e)
        total += np.bincount(room * CELLS[1] + dish, minlength=len(total))
    k = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k], pa.int64())], names=["cell", "n"])


def byte_model(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 probabilities of dishes in the restaurants of bytes, averaged over sampled seatings."""
    far = np.zeros(CELLS[0] * CELLS[1])
    far[cells] = counts
    far = far.reshape(CELLS)
    rng, d, mean = np.random.default_rng(3), DISCOUNT["bytes"], np.zeros(CELLS)
    near_p, root_p = np.full((257, 257), 1 / 257), np.full(257, 1 / 257)
    for sweep in range(SAMPLES + 1):
        def level(customers, parent):
            tables_now = np.minimum(customers, 1).sum(axis=-1, keepdims=True)
            mass = (STRENGTH + d * tables_now) * parent
            t = seated(customers.ravel(), np.broadcast_to(mass, customers.shape).ravel(), d, rng).reshape(customers.shape)
            return t

        def predict(customers, t, parent):
            return (np.maximum(customers - d * t, 0) + (STRENGTH + d * t.sum(axis=-1, keepdims=True)) * parent) / (STRENGTH + customers.sum(axis=-1, keepdims=True))

        t_far = level(far, np.repeat(near_p, FAR, axis=0))
        near = t_far.reshape(257, FAR, 257).sum(axis=1)
        t_near = level(near, root_p[None, :])
        root = t_near.sum(axis=0)
        t_root = level(root, np.full(257, 1 / 257))
        root_p = predict(root, t_root, 1 / 257)
        near_p = predict(near, t_near, root_p[None, :])
        if sweep:  # the first is burnt
            mean += predict(far, t_far, np.repeat(near_p, FAR, axis=0)) / SAMPLES
    return np.log10(mean)


def spelled(raw: np.ndarray, s: np.ndarray, e: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Probability of each word under the byte model."""
    return 10.0 ** spelled_log(raw, s, e, model)


def spelled_log(raw: np.ndarray, s: np.ndarray, e: np.ndarray, model: np.ndarray) -> np.ndarray:
    """The same as log10, which long words do not take to zero."""
    if not len(s):
        return np.zeros(0)
    word, room, dish = byte_cells(raw, s, e)
    return np.bincount(word, model[room, dish], minlength=len(s))


def _based(model):
    """Words' ids, counts, customers and base probabilities; the start of a text is no dish."""
    def run(batches):
        for batch in batches:
            raw, s, e = _spans(batch.column("word"))
            ids = Prefix(raw)(s, e) if len(s) else np.zeros(0, np.uint64)
            dish, c = ids != id_of(START), batch.column("c").to_numpy()
            yield pa.RecordBatch.from_arrays([signed(ids), pa.array(c), pa.array(c * dish), pa.array(spelled(raw, s, e, model.value) * dish)], names=["id", "c", "dish", "base"])

    return run


def chains(name: str) -> list[str]:
    return [f"{name}{k}" for k in CHAINS]


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(x).to_numpy(zero_copy_only=False) for x in names]


def _rng(batch: pa.RecordBatch, *names: str) -> np.random.Generator:
    return np.random.default_rng(int(sum(np.add.reduce(x.view(np.uint64), dtype=np.uint64) >> np.uint64(1) for x in _numbers(batch, *names))))


SEATED = "u long, w long, n long, " + ", ".join(f"t{k} int" for k in CHAINS)


def _seat(batches):
    """Tables of the dishes of contexts, per chain."""
    for batch in batches:
        rng, n = _rng(batch, "u", "w"), batch.column("n").to_numpy()
        seats = [seated(n, np.multiply(*_numbers(batch, f"u_mass{k}", f"w_p{k}")), DISCOUNT["context"], rng) for k in CHAINS]
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("w"), batch.column("n"), *[pa.array(t.astype(np.int32)) for t in seats]],
                                         names=["u", "w", "n", *chains("t")])


GUESTS = "id long, c long, base double, " + ", ".join(f"{x}{k} double" for x in ("own", "guests", "tables") for k in CHAINS)


def _seat_words(tables: list[float]):
    """Tables of the words in the parent, per chain, given all tables there."""
    def run(batches):
        for batch in batches:
            rng, base = _rng(batch, "id"), batch.column("base").to_numpy()
            seats = [seated(batch.column(f"guests{k}").to_numpy(), (STRENGTH + DISCOUNT["word"] * tables[k]) * base, DISCOUNT["word"], rng) for k in CHAINS]
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in ("id", "c", "base", *chains("own"), *chains("guests"))], *map(pa.array, seats)],
                                             names=[x.split()[0] for x in GUESTS.split(", ")])

    return run


class Parent:
    """The restaurant of all words after a sweep, and each word's figures: count, tables as a context with the strength, probability as a dish.

    ``moved`` has the pairs of several customers with their tables; all other customers of a word have a table each.
    """

    def __init__(self, vocabulary: DataFrame, moved: DataFrame, tables: list[float]):
        # One aggregate by word, of its own row and of what its pairs tell on either side.
        zero = F.lit(0).cast("long")
        told = [f"{name}{k}" for name in ("own", "guests") for k in CHAINS]
        rows = vocabulary.select("id", "c", "dish", "base", *[zero.alias(x) for x in told])
        for side, name in (("u", "own"), ("w", "guests")):
            more = {f"{name}{k}": F.col(f"t{k}") - F.col("n") for k in CHAINS}
            rows = rows.unionByName(moved.select(F.col(side).alias("id"), zero.alias("c"), zero.alias("dish"), F.lit(0.0).alias("base"), *[more.get(x, zero).cast("long").alias(x) for x in told]))
        rows = rows.groupBy("id").agg(*[F.sum(x).alias(x) for x in ("c", "dish", "base", *told)])
        words_now = rows.select("id", "c", "base", *[(F.col(total) + F.col(f"{name}{k}")).cast("double").alias(f"{name}{k}") for name, total in (("own", "c"), ("guests", "dish")) for k in CHAINS])
        seats = stored(words_now.mapInArrow(_seat_words(tables), GUESTS), "words")
        sums = seats.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in (*chains("guests"), *chains("tables"))]).first()
        self.tables, guests = [sums[x] for x in chains("tables")], [sums[x] for x in chains("guests")]
        d = DISCOUNT["word"]
        self.fresh = [(STRENGTH + d * self.tables[k]) / (STRENGTH + guests[k]) for k in CHAINS]
        figures = seats.select("id", "c", *[(STRENGTH + DISCOUNT["context"] * F.col(f"own{k}")).alias(f"mass{k}") for k in CHAINS],
                               *[((F.col(f"guests{k}") - d * F.col(f"tables{k}")) / (STRENGTH + guests[k]) + self.fresh[k] * F.col("base")).alias(f"p{k}") for k in CHAINS])
        often = frequent(figures, "c")
        self.often, self.rare = F.broadcast(figures.filter(often)), figures.filter(~often)

    def told(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the figures of both words, null where a word is unknown."""
        for side, columns in (("u", ["c", *chains("mass")]), ("w", ["c", *chains("p")])):
            def named(df):
                return df.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])

            found = pairs.join(named(self.often), side, "left")
            there = F.col(f"{side}_c").isNotNull()
            pairs = found.filter(there).unionByName(found.filter(~there).select(pairs.columns).join(named(self.rare), side, "left"))
        return pairs


def frequent(df: DataFrame, count: str):
    """Condition on a count that at most ``FREQUENT`` rows meet; steps of a tenth."""
    step = F.floor(F.log(count) * 10)
    least, so_far = None, 0
    for k, n in sorted(((r["k"], r["n"]) for r in df.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        so_far += n
        if so_far > FREQUENT:
            break
        least = k
    return step >= least if least is not None else F.lit(False)


def seen(parent: Parent, pairs: DataFrame) -> DataFrame:
    """(u, w, n, log) of pairs with customers ``n`` and their mean tables ``t``: the averaged probability of the word in the context."""
    p = (F.col("n") - DISCOUNT["context"] * F.col("t") + sum(F.col(f"u_mass{k}") * F.col(f"w_p{k}") for k in CHAINS) / SAMPLES) / (STRENGTH + F.col("u_c"))
    return parent.told(pairs).select("u", "w", "n", F.log10(p).alias("log"))


READ = "uid long, doc_id long, n_tokens long, n_known long, base double, score double, u long, w long, n long, alone float"
LOOSE = "uid long, u long, w long, n long, owed long, first double, spelt double"


class Figures:
    """Of the tokens of some texts: which pairs are known by heart, and the figures of frequent words."""

    def __init__(self, t: Tokens, known: tuple):
        self.pairs, self.logs, self.ids, self.base, self.room, self.mass, self.p = known
        place, there = self.found(self.ids, t.id)
        start, start_there = self.found(self.ids, np.array([id_of(START)]))
        first = t.before == id_of(START)
        self.word, self.context = place, np.where(first, start, np.roll(place, 1))
        self.there = there
        self.sure = there & np.where(first, start_there, np.roll(there, 1))

    @staticmethod
    def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


def counted_rows(t: Tokens, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs at some places one place per text, and how often it is there."""
    _, pick, times = np.unique(mixed(pair_keys(t.before[which], t.id[which])) + t.row[which].astype(np.uint64), return_index=True, return_counts=True)
    return which[pick], times


def _read(known):
    """Frequent pairs are scored at once. Each other pair of frequent words gives a row with its score if no other text has it, and each document a row with its sums."""
    names = [x.split()[0] for x in READ.split(", ")]

    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                t = Tokens(batch.column("text")[lo:hi])
                x, docs = Figures(t, known.value), len(t.n)
                at, hit = x.found(x.pairs, pair_keys(t.before, t.id))
                hit &= x.sure
                uid, zero = batch.column("uid")[lo:hi], pa.array(np.zeros(docs, np.int64))
                # A document's own row joins with nothing, as no word has the id 0.
                yield pa.RecordBatch.from_arrays([
                    uid, batch.column("doc_id")[lo:hi], pa.array(t.n), pa.array(np.bincount(t.row[x.there], minlength=docs)),
                    pa.array(np.bincount(t.row[x.there], x.base[x.word[x.there]], minlength=docs) * 1.0), pa.array(np.bincount(t.row[hit], x.logs[at[hit]], minlength=docs) * 1.0),
                    uid, zero, zero, pa.array(np.zeros(docs, np.float32))], names=names)
                rest, times = counted_rows(t, np.flatnonzero(x.sure & ~hit))
                held = batch.column("held")[lo:hi].to_numpy(zero_copy_only=False)[t.row[rest]]
                c, w = x.context[rest], x.word[rest]
                alone = np.log10((np.where(held, 0, 1 - DISCOUNT["context"]) + (x.mass[c] * x.p[w]).mean(axis=1)) / x.room[c]) if len(rest) else np.zeros(0)
                none = pa.array(np.zeros(len(rest), np.int64))
                yield pa.RecordBatch.from_arrays([
                    uid.take(pa.array(t.row[rest])), pa.nulls(len(rest), pa.int64()), none, none, pa.array(np.zeros(len(rest))), pa.array(np.zeros(len(rest))),
                    signed(t.before[rest]), signed(t.id[rest]), pa.array(times.astype(np.int64)), pa.array(alone.astype(np.float32))], names=names)

    return run


def _read_loose(known, letters):
    """The pairs with a word that is not frequent; ``owed`` counts those where it is the second."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                t = Tokens(batch.column("text")[lo:hi])
                x = Figures(t, known.value)
                rest, times = counted_rows(t, np.flatnonzero(~x.sure))
                held = batch.column("held")[lo:hi].to_numpy(zero_copy_only=False)[t.row[rest]]
                spelt, ends = np.zeros(len(t.id)), np.ones(len(t.id), bool)
                ends[t.place] = False
                spelt[ends] = spelled_log(np.frombuffer(END, np.uint8), np.array([0]), np.array([1]), letters.value)[0]
                unknown = np.zeros(len(t.id), bool)  # of held-out texts alone
                unknown[rest[held & ~x.there[rest]]] = True
                k = np.flatnonzero(unknown[t.place])
                spelt[t.place[k]] = spelled_log(t.raw, t.s[k], t.e[k], letters.value)
                yield pa.RecordBatch.from_arrays([
                    batch.column("uid")[lo:hi].take(pa.array(t.row[rest])), signed(t.before[rest]), signed(t.id[rest]), pa.array(times.astype(np.int64)),
                    pa.array(np.where(x.there[rest], 0, times)), pa.array(np.where(held, 0, 1 - DISCOUNT["context"])), pa.array(spelt[rest])],
                    names=[f.split()[0] for f in LOOSE.split(", ")])

    return run


def score_documents(docs: DataFrame, *, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of all documents under a model of those whose crc32(doc_id as text) mod ``folds`` is not ``held``."""
    spark = docs.sparkSession
    out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == held
    docs = docs.select("doc_id", "text", out.alias("held"))
    counted = stored(docs.filter(~F.col("held")).select("text").mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    dishes = counted.filter(F.col("word") != F.lit(bytearray(START)))
    kinds, n_all = dishes.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    cells = dishes.select("word").mapInArrow(_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    letters = spark.sparkContext.broadcast(byte_model(cells.column("cell").to_numpy(), cells.column("n").to_numpy()))
    vocabulary = stored(counted.mapInArrow(_based(letters), "id long, c long, dish long, base double"), "vocabulary")
    # Pairs that training texts have once are looked up by held-out texts alone.
    pairs = docs.select("text", "held").mapInArrow(_pairs, "u long, w long, n long").groupBy("u", "w").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    pairs = stored(pairs.filter("n > 1 or n = 1 and least = 0").drop("least"), "pairs")
    moved = pairs.filter("n > 1").select("u", "w", "n", *[F.lit(1).alias(f"t{k}") for k in CHAINS])
    parent = Parent(vocabulary, moved, [float(kinds)] * SAMPLES)
    for _ in range(SWEEPS):  # the first is burnt
        moved = stored(parent.told(moved.select("u", "w", "n")).mapInArrow(_seat, SEATED), "seats")
        parent = Parent(vocabulary, moved, parent.tables)
    moved = moved.select("u", "w", "n", (sum(F.col(x) for x in chains("t")) / SAMPLES).alias("t"))
    model = stored(seen(parent, moved.unionByName(pairs.filter("n = 1").withColumn("t", F.lit(1.0)))), "model")
    often = frequent(model.filter("n > 1"), "n")
    top = model.filter(often & (F.col("n") > 1)).select("u", "w", "log").toArrow()
    keys = pair_keys(*[top.column(x).to_numpy().view(np.uint64) for x in "uw"])
    order = np.argsort(keys)
    heart = parent.often.toArrow()
    ids = heart.column("id").to_numpy().view(np.uint64)
    rank, c = np.argsort(ids), heart.column("c").to_numpy()
    known = spark.sparkContext.broadcast((
        keys[order], top.column("log").to_numpy()[order], ids[rank], np.log10((c[rank] + 1) / (n_all + kinds + 1)), STRENGTH + c[rank],
        *[np.stack([heart.column(x).to_numpy()[rank] for x in chains(name)], axis=1) for name in ("mass", "p")]))
    key = F.xxhash64("u", "w").alias("key")
    # Read twice in one order, so a row has one number.
    docs = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", "held")
    sure = docs.mapInArrow(_read(known), READ).select(key, "uid", "doc_id", "n_tokens", "n_known", "base", "score", "n", "alone").join(model.filter(~often | (F.col("n") == 1)).select(key, "log"), "key", "left")
    sure = sure.select("uid", "doc_id", "n_tokens", "n_known", "base", (F.col("score") + F.col("n") * F.coalesce("log", "alone")).alias("score"))
    loose = stored(docs.drop("doc_id").mapInArrow(_read_loose(known, letters), LOOSE).select("*", key).join(model.select(key, "log"), "key", "left").drop("key"), "loose")
    room = F.coalesce("u_c", F.lit(0)) + STRENGTH

    def mean(p):
        return sum(F.coalesce(f"u_mass{k}", F.lit(STRENGTH)) * p(k) for k in CHAINS) / SAMPLES

    unknown = F.log10(mean(lambda k: F.lit(parent.fresh[k])) / room) + F.col("spelt")
    log = F.coalesce("log", F.when(F.col("w_c").isNull(), unknown).otherwise(F.log10((F.col("first") + mean(lambda k: F.col(f"w_p{k}"))) / room)))
    nothing = F.lit(0).cast("long")
    loose = parent.told(loose).select("uid", F.lit(None).cast("long").alias("doc_id"), nothing.alias("n_tokens"), F.when(F.col("w_c") > 0, F.col("owed")).otherwise(0).alias("n_known"),
                                      (F.col("owed") * F.log10((F.coalesce("w_c", F.lit(0)) + 1) / F.lit(float(n_all + kinds + 1)))).alias("base"), (F.col("n") * log).alias("score"))
    # Only a document's own row has its id.
    done = sure.unionByName(loose).groupBy("uid").agg(F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")])
    return done.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
                       F.col("base").alias("base_score"), "score")


def op3(docs: DataFrame) -> DataFrame:
    return score_documents(docs)
