"""Document scores by a recurrent language model, next to a smoothed unigram base.

1. Words are counted over all documents (partial counts per task, then one
   shuffle).  Training documents are those whose crc32 of the id leaves a
   remainder other than 2 by 7.
2. Words with at least a millionth of all tokens, or of the training tokens - two
   million words at most, whatever the data - are broadcast with their counts.
   The commonest in training form the head; training counts alone shape classes.
3. Texts are turned into token numbers once and written; training and scoring
   read the numbers.
4. Training goes over the training documents once, in ``ROUNDS`` disjoint parts.
   A part is dealt by hash to shards of about ``SHARD_TOKENS`` tokens, long
   documents to shards of their own; every shard trains the network from the same weights, and these are averaged, weighed by
   tokens, before the next round.  Shards follow from the documents, not from
   files or tasks, so neither does the model.
5. Every task scores its documents, whole, state carried throughout.  Words
   outside the broadcast are joined with their counts; as each holds less than a
   millionth of the tokens, no key of that join is hot.

A word outside the head has a class by its ending, apart for frequent and rare
words, and within it the probability (c+1)/(sum of (c+1) over the class + 1).

Null and empty texts hold the end token alone.  Without an id a document is one
for training.  Repeated rows count and score each.  Without training documents
every token has the base probability 1.  A very long text is one task's work,
token by token; it is never cut.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.gru import Layout, Network
from tidemark.llm.tables import column, map_arrow, slices, staged

HOT_SHARE = 1_000_000
HEAD_CLASSES, PER_CLASS, TAIL_CLASSES = 16, 64, 16
CHUNK_TOKENS = 5_000_000
ROUNDS, SHARD_TOKENS = 4, 4_000_000
# Longer documents are trained on and scored side by side, as next to short ones
# most lanes would run empty.
LONG_TOKENS = 4096
_PIECES = 16
COUNTED_WORDS = 300_000
CACHED_WORDS = 150_000
_END = b""


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words in lower case (A-Z only), then the end token."""
    words = text.lower().split() if text else []
    words.append(_END)
    return words


def _ending(word: bytes) -> int:
    return zlib.crc32(word[-4:]) % TAIL_CLASSES


class Vocabulary:
    """Numbers for the broadcast words, by falling training count; 0 is the end token."""

    def __init__(self, hot: list[tuple[bytes, int]], total: int):
        hot = [(_END, next((c for w, c in hot if w == _END), 0))] + [x for x in hot if x[0] != _END]
        self.counts = np.array([c for _, c in hot], np.int64)
        self.hot = len(hot)
        self.numbers = {w: i for i, (w, _) in enumerate(hot)}
        # The broadcast has more words than these, for joins alone.
        frequent = self.counts * HOT_SHARE >= max(1, total)
        frequent[0] = True
        self.head = min(HEAD_CLASSES * PER_CLASS, int(frequent.sum()))
        classes = np.zeros(self.hot + TAIL_CLASSES, np.int32)
        within = np.zeros(len(classes), np.int32)
        # Neighbours in rank share a class.
        at = np.arange(self.head)
        classes[: self.head], within[: self.head] = at // PER_CLASS, at % PER_CLASS
        for i in range(self.head, self.hot):
            classes[i] = HEAD_CLASSES + _ending(hot[i][0]) + (0 if frequent[i] else TAIL_CLASSES)
        classes[self.hot :] = HEAD_CLASSES + TAIL_CLASSES + np.arange(TAIL_CLASSES)
        self.classes, self.within = classes, within
        self.entry = np.where(
            np.arange(len(classes)) < self.head, np.arange(len(classes)), HEAD_CLASSES * PER_CLASS + classes
        ).astype(np.int32)

    def lookup(self) -> dict:
        return _Lookup(self.numbers, self.hot)

    def class_counts(self, rare: np.ndarray) -> np.ndarray:
        """Training tokens by class; ``rare`` has those of words outside the broadcast."""
        n = np.bincount(
            self.classes[: self.hot], weights=self.counts, minlength=HEAD_CLASSES + 2 * TAIL_CLASSES
        )
        n[HEAD_CLASSES + TAIL_CLASSES :] += rare
        return n


class _Lookup(dict):
    def __init__(self, numbers: dict, hot: int):
        super().__init__(numbers)
        self.hot = hot

    def __missing__(self, word: bytes) -> int:
        number = self.hot + _ending(word)
        if len(self) < self.hot + CACHED_WORDS:
            self[word] = number
        return number


def _layout() -> Layout:
    return Layout(HEAD_CLASSES, PER_CLASS, HEAD_CLASSES + 2 * TAIL_CLASSES)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n_train`` and ``n_all`` from ``text`` and ``held_out``."""

    def run(batches):
        train, rest = Counter(), Counter()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for text, held in zip(texts, batch.column(1).to_pylist(), strict=True):
                (rest if held else train).update(tokens_of(text))
                if len(train) + len(rest) > COUNTED_WORDS:
                    yield from (_counted(train, 1), _counted(rest, 0))
                    train, rest = Counter(), Counter()
        yield from (_counted(train, 1), _counted(rest, 0))

    partial = map_arrow(
        docs.select("text", "held_out"), run, "word binary, n_train bigint, n_all bigint"
    )
    return partial.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def _counted(words: Counter, in_training: int) -> pa.RecordBatch:
    n = np.fromiter(words.values(), np.int64, len(words))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.binary()), pa.array(n * in_training), pa.array(n)],
        ["word", "n_train", "n_all"],
    )


def _class_mass(rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """By ending: training tokens, and the sum of (c+1), of the words outside the broadcast."""

    def run(batches):
        for batch in batches:
            ends = np.array([_ending(w) for w in batch.column(0).to_pylist()], np.int64)
            c = batch.column(1).to_numpy(zero_copy_only=False)
            n = np.bincount(ends, weights=c, minlength=TAIL_CLASSES).astype(np.int64)
            m = np.bincount(ends, weights=c + 1, minlength=TAIL_CLASSES).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(TAIL_CLASSES)), pa.array(n), pa.array(m)], ["ending", "n", "m"]
            )

    known = rare.where("n_train > 0").select("word", "n_train")
    sums = map_arrow(known, run, "ending bigint, n bigint, m bigint")
    n, m = np.zeros(TAIL_CLASSES, np.int64), np.zeros(TAIL_CLASSES, np.int64)
    for row in sums.groupBy("ending").agg(F.sum("n"), F.sum("m")).collect():
        n[row[0]], m[row[0]] = row[1], row[2]
    return n, m


_NUMBERED = (
    "place bigint, doc_id {id}, held_out boolean, drawn bigint, n_tokens bigint, numbers binary, "
    "words array<binary>"
)


def _numbered(docs: DataFrame, vocabulary) -> DataFrame:
    """A row per document: its tokens as 32-bit numbers, and its words outside the broadcast, repeats included."""
    schema = StructType.fromDDL(_NUMBERED.format(id="bigint"))
    schema["doc_id"].dataType = docs.schema["doc_id"].dataType
    arrow = to_arrow_schema(schema)

    def run(batches):
        v = vocabulary.value
        lookup, hot = v.lookup(), v.hot
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, 0):
                numbers, sizes, words = [], [], []
                for text in part.column(0).cast(pa.binary()).to_pylist():
                    document = tokens_of(text)
                    found = np.fromiter(map(lookup.__getitem__, document), np.int32, len(document))
                    numbers.append(found.tobytes())
                    sizes.append(len(document))
                    words.append([document[i] for i in np.flatnonzero(found >= hot).tolist()])
                n = part.num_rows
                made = [
                    pa.array(np.arange(place, place + n)),
                    part.column(2),
                    part.column(1),
                    part.column(3),
                    pa.array(sizes, pa.int64()),
                    pa.array(numbers, pa.binary()),
                    pa.array(words, arrow.field("words").type),
                ]
                place += n
                yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return map_arrow(docs, run, schema)


def _arrays(column_of_numbers) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column_of_numbers.to_pylist()]


def train(numbered: DataFrame, vocabulary, start: np.ndarray) -> np.ndarray:
    """The network's weights after ``ROUNDS`` rounds over disjoint parts of the training documents."""
    spark = numbered.sparkSession
    rows = numbered.where("not held_out")
    is_long = F.col("n_tokens") > LONG_TOKENS
    tokens = {r[0]: r[1] for r in rows.groupBy(is_long).agg(F.sum("n_tokens")).collect()}
    short, long = (-(-tokens.get(k, 0) // (ROUNDS * SHARD_TOKENS)) for k in (False, True))
    drawn = F.col("drawn")
    among = lambda n: F.pmod(F.floor(drawn / ROUNDS).cast("bigint"), F.lit(max(1, n)))
    dealt = rows.select(
        F.pmod(drawn, F.lit(ROUNDS)).alias("round"),
        F.when(is_long, among(long) + short).otherwise(among(short)).cast("int").alias("shard"),
        "drawn",
        "numbers",
    )
    # Weights, and what the network has seen of each weight's gradient.
    state = np.concatenate((start, np.full(len(start), Network.UNSEEN, np.float32)))
    for number in range(ROUNDS if tokens else 0):
        part = dealt.where(F.col("round") == number).drop("round")
        part = part.repartitionByRange(short + long, "shard")
        part = part.sortWithinPartitions("shard", "drawn", "numbers")
        shared = spark.sparkContext.broadcast(state)
        state = _averaged(_trained(part, vocabulary, shared), state)
    return state[: len(start)]


_TRAINED = "piece int, shard int, seen bigint, value binary"


def _trained(part: DataFrame, vocabulary, shared) -> DataFrame:
    """What each shard's training ends with, cut into pieces."""

    def run(batches):
        v, layout = vocabulary.value, _layout()
        shard, network, seen, open_, size = None, None, 0, [], 0

        def learn():
            nonlocal seen, open_, size
            if open_:
                seen += network.train(open_, v.entry, v.classes, v.within)
                open_, size = [], 0

        def closed():
            values = np.concatenate((layout.flat(network.w), layout.flat(network.seen)))
            pieces = np.array_split(values.astype(np.float32), _PIECES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(_PIECES, dtype=np.int32)),
                    pa.array(np.full(_PIECES, shard, np.int32)),
                    pa.array(np.full(_PIECES, seen, np.int64)),
                    pa.array([p.tobytes() for p in pieces], pa.binary()),
                ],
                ["piece", "shard", "seen", "value"],
            )

        for batch in batches:
            for now, numbers in zip(batch.column(0).to_pylist(), _arrays(batch.column(2)), strict=True):
                if now != shard:
                    if network is not None:
                        learn()
                        yield from closed()
                    weights, before = np.split(shared.value, 2)
                    shard, seen = now, 0
                    network = Network(layout, layout.unflat(weights), layout.unflat(before))
                open_.append(numbers)
                size += len(numbers)
                if size >= CHUNK_TOKENS:
                    learn()
        if network is not None:
            learn()
            yield from closed()

    return map_arrow(part, run, _TRAINED)


def _averaged(trained: DataFrame, state: np.ndarray) -> np.ndarray:
    """The mean over shards, weighed by tokens; ``state`` where there are none.

    Each piece is summed in the order of the shards, so reruns agree.
    """

    def run(batches):
        piece, total, weight = None, None, 0
        for batch in batches:
            for k, _, seen, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != piece and piece is not None:
                    yield _piece(piece, total / weight)
                if k != piece:
                    piece, total, weight = k, 0.0, 0
                total = total + np.frombuffer(value, np.float32).astype(np.float64) * seen
                weight += seen
        if piece is not None:
            yield _piece(piece, total / weight)

    ordered = trained.repartition("piece").sortWithinPartitions("piece", "shard")
    rows = map_arrow(ordered, run, "piece int, value binary").collect()
    if not rows:
        return state
    means = [np.frombuffer(r.value, np.float64) for r in sorted(rows, key=lambda r: r.piece)]
    return np.concatenate(means).astype(np.float32)


def _piece(piece: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([piece], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["piece", "value"]
    )


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base and model log10-probabilities of every text."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(column(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    # Neither a hot id nor copies of a text share a hash, and no other document has a say in it.
    drawn = F.xxhash64(F.lit("lm"), column(doc_id), column(text))
    docs = docs.select(
        column(text).alias("text"), held.alias("held_out"), column(doc_id).alias("doc_id"), drawn.alias("drawn")
    )
    counts = staged(word_counts(docs), "lm-counts")
    total, kinds, tokens = counts.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)),
        F.count_if(F.col("n_train") > 0),
        F.coalesce(F.sum("n_all"), F.lit(0)),
    ).first()
    # The end token is broadcast even where documents are very long.  A word that
    # is frequent in training is, whatever the other documents hold.
    hot = (
        (F.col("n_all") * HOT_SHARE >= tokens)
        | ((F.col("n_train") > 0) & (F.col("n_train") * HOT_SHARE >= total))
        | (F.length("word") == 0)
    )
    known = [(bytes(r.word), r.n_train) for r in counts.where(hot).toLocalIterator()]
    known.sort(key=lambda x: (-x[1], x[0]))
    rare = counts.where(~hot)
    v = Vocabulary(known, total)
    rare_tokens, rare_mass = _class_mass(rare)

    layout = _layout()
    words = np.zeros(HEAD_CLASSES * PER_CLASS)
    words[: v.head] = v.counts[: v.head]
    vocabulary = spark.sparkContext.broadcast(v)
    numbered = staged(_numbered(docs, vocabulary), "lm-numbers")
    start = layout.flat(layout.start(v.class_counts(rare_tokens), words))
    weights = spark.sparkContext.broadcast(train(numbered, vocabulary, start))

    # What a class divides by, and what a word outside the head adds.
    mass = np.bincount(
        v.classes[v.head : v.hot],
        weights=(v.counts[v.head :] + 1) * (v.counts[v.head :] > 0),
        minlength=layout.classes,
    )
    mass[HEAD_CLASSES + TAIL_CLASSES :] += rare_mass
    log_mass = np.log10(mass + 1)
    log_mass[:HEAD_CLASSES] = 0
    is_long = F.col("n_tokens") > LONG_TOKENS
    tokens_of_long = numbered.where(is_long).agg(F.sum("n_tokens")).first()[0] or 0
    together = numbered.where(is_long).repartition(-(-tokens_of_long // CHUNK_TOKENS) or 1)
    scored = _scored(numbered.where(~is_long), vocabulary, weights, log_mass)
    scored = staged(scored.union(_scored(together, vocabulary, weights, log_mass)), "lm-scores")
    return _put_together(scored, numbered, rare, total, kinds)


_SCORED = (
    "place bigint, doc_id {id}, held_out boolean, n_tokens bigint, n_known bigint, base double, model double"
)


def _scored(numbered: DataFrame, vocabulary, weights, log_mass) -> DataFrame:
    """A row per document, without the counts of the words that are still to be joined."""
    schema = StructType.fromDDL(_SCORED.format(id="bigint"))
    schema["doc_id"].dataType = numbered.schema["doc_id"].dataType
    names = schema.names

    def run(batches):
        v, layout = vocabulary.value, _layout()
        network = Network(layout, layout.unflat(weights.value))
        log_count = np.concatenate((np.log10(v.counts + 1), np.zeros(TAIL_CLASSES)))
        is_known = np.concatenate((v.counts > 0, np.zeros(TAIL_CLASSES, bool)))
        in_class = np.where(np.arange(len(v.classes)) < v.head, 0, log_count) - log_mass[v.classes]
        for rows, numbers in _chunks(batches):
            model = network.log_likelihoods(numbers, v.entry, v.classes, v.within) / np.log(10)
            every = np.concatenate(numbers)
            begins = np.concatenate(([0], np.cumsum([len(x) for x in numbers])[:-1]))
            model += np.add.reduceat(in_class[every], begins)
            made = [
                pa.array(np.add.reduceat(is_known[every].astype(np.int64), begins)),
                pa.array(np.add.reduceat(log_count[every], begins)),
                pa.array(model),
            ]
            yield pa.RecordBatch.from_arrays([*rows, *made], names)

    return map_arrow(numbered.select("place", "doc_id", "held_out", "n_tokens", "numbers"), run, schema)


def _chunks(batches):
    """Other columns and token numbers of documents, about ``CHUNK_TOKENS`` at a time."""
    kept, numbers, n = [], [], 0

    def together():
        table = pa.Table.from_batches(kept).combine_chunks()
        return [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]

    for batch in batches:
        sizes = np.cumsum(batch.column(3).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = int(sizes[begin - 1]) if begin else 0
            room = before + CHUNK_TOKENS - n
            end = max(begin + 1, int(np.searchsorted(sizes, room, "right")))
            part = batch.slice(begin, end - begin)
            kept.append(part.select(["place", "doc_id", "held_out", "n_tokens"]))
            numbers += _arrays(part.column(4))
            n += int(sizes[end - 1]) - before
            begin = end
            if n >= CHUNK_TOKENS or begin < batch.num_rows:
                yield together(), numbers
                kept, numbers, n = [], [], 0
    if numbers:
        yield together(), numbers


def _put_together(
    scored: DataFrame, numbered: DataFrame, rare: DataFrame, total: int, kinds: int
) -> DataFrame:
    asked = numbered.select("place", F.explode("words").alias("word"))
    found = (
        asked.join(rare.where("n_train > 0").select("word", "n_train"), "word")
        .groupBy("place")
        .agg(
            F.sum(F.log10(F.col("n_train") + 1)).alias("more"),
            F.count(F.lit(1)).alias("more_known"),
        )
    )
    more = F.coalesce("more", F.lit(0.0))
    each = float(np.log10(total + kinds + 1))
    return scored.join(found, "place", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * each).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
