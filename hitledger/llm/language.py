"""Language identification in two steps: family first, then pairs of related languages.

A text is a vector of hashed byte trigrams (letters folded, everything else one blank),
square roots of counts at unit length. One-versus-one linear support vector machines vote
on the language family; those between the languages of the winning family then decide.

The machines are fitted on all different texts that have a language, each used whole: their
trigram counts are stored once, and every step of the descent is a pass over them that adds up
the losses and slopes of all machines. Centres and floors come from all of them as well. A
prediction is one matrix product per slice of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.batches import importable, let_go, map_batches, slices
from hitledger.llm.frames import released, stored, without

# Entries of a text's vector.
BUCKETS = 4096
# Texts turned into vectors at a time.
ROWS = 256
# Strength of the penalty, most passes of the fit, the part of its first slope at which a
# machine is done, and the moves it remembers.
PENALTY = 1e-3
PASSES = 30
DONE = 5e-3
MOVES = 10
# Margin to confidence: the slope of the logistic function.
SLOPE = 4.0
# A text must be so much of what a tenth of the labelled texts are below in likeness.
FLOOR = 0.45
UNKNOWN = "und"

# Languages by family. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "am ar he mt",
    "iranian": "fa ku ps tg",
    "indic": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su tl",
}

ADDED = ("lang_pred", "score")
LETTER = regex.compile(r"\p{L}")


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members.split()), language)


def _folds() -> np.ndarray:
    """Letters to lower case, other ASCII to a blank, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint32)
    for b in range(128):
        table[b] = b | 32 if chr(b).isalpha() else 32
    return table


FOLDS = _folds()


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of trigram counts per text; texts of under three bytes have none."""
    n = len(offsets) - 1
    folded = FOLDS[data]
    if len(folded) < 3:
        return np.zeros((n, BUCKETS), np.int64)
    grams = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    bucket = ((grams * np.uint32(2654435761)) >> shift).astype(np.int64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    inside = row[:-2] == row[2:]
    bucket = (row[:-2] * BUCKETS + bucket)[inside]
    return np.bincount(bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of trigram weights per text."""
    counts = np.sqrt(gram_counts(data, offsets)).astype(np.float32)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


def packed(counts: np.ndarray) -> list[bytes]:
    """Each row of counts in few bytes: a bit for every entry, whether it is there; then the
    low bytes of those that are, the bytes above them, and so on up to the largest."""
    there = counts > 0
    out = []
    for row, mask, bits in zip(counts, there, np.packbits(there, axis=1), strict=True):
        found = row[mask].astype("<u4")
        wide = (int(found.max(initial=0)).bit_length() + 7) // 8
        out.append(bits.tobytes() + found.view(np.uint8).reshape(-1, 4)[:, :wide].T.tobytes())
    return out


def unpacked(column: pa.Array) -> np.ndarray:
    """The vectors of packed counts, and a last column of ones."""
    x = np.zeros((len(column), BUCKETS + 1), np.float32)
    x[:, -1] = 1
    for out, piece in zip(x, column, strict=True):
        raw = np.frombuffer(piece.as_buffer(), np.uint8)
        mask = np.unpackbits(raw[: BUCKETS // 8]).view(bool)
        if n := np.count_nonzero(mask):
            levels = raw[BUCKETS // 8 :].reshape(-1, n)
            found = sum(level.astype(np.float64) * 256**k for k, level in enumerate(levels))
            out[:-1][mask] = np.sqrt(found / found.sum())
    return x


@dataclass
class Model:
    """Machines as rows of ``weights``: pair (a, b) is positive for a. ``names`` lists the
    families, then each family's languages, as groups that vote among themselves."""

    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1), np.float32))
    # Each language's mean vector, of two thirds of its texts, and the least likeness to it
    # that texts of a size have (none before ``calibrate``).
    centres: dict[str, np.ndarray] = field(default_factory=dict)
    floors: dict[str, np.ndarray] = field(default_factory=dict)

    def strange(self, x: np.ndarray, sizes: np.ndarray, names: list[str]) -> np.ndarray:
        """Whether a text is less like its language than any clean text of its size."""
        likeness = np.array([v @ self.centres[name] for v, name in zip(x, names, strict=True)])
        return likeness < [self.floors[name][c] for name, c in zip(names, size_class(sizes), strict=True)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:, :-1].T + self.weights[:, -1]

    def vote(self, margins: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row (most duels won, then the larger sum of margins), and its
        least confidence over its duels."""
        wins = np.zeros((len(margins), len(names)))
        least = np.full((len(margins), len(names)), np.inf)
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                if i != j:
                    m = margins[:, self.pairs[a, b]] if (a, b) in self.pairs else -margins[:, self.pairs[b, a]]
                    wins[:, i] += (m > 0) + 1e-3 * np.tanh(m)
                    least[:, i] = np.minimum(least[:, i], m)
        best = wins.argmax(axis=1)
        margin = least[np.arange(len(best)), best]
        return best, 1 / (1 + np.exp(-SLOPE * margin))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = self.margins(x)
        family, sure = self.vote(margins, self.families)
        named, score = np.empty(len(x), object), np.ones(len(x))
        for k, name in enumerate(self.families):
            mine = np.flatnonzero(family == k)
            if len(mine):
                best, inner = self.vote(margins[mine], self.languages[name])
                named[mine] = np.array(self.languages[name], object)[best]
                score[mine] = sure[mine] * inner
        return list(named), score


def size_class(sizes: np.ndarray) -> np.ndarray:
    """0 for under 32 bytes, then one more for each doubling, up to 7."""
    return np.clip(np.log2(np.maximum(sizes, 1) / 16).astype(int), 0, 7)


def _labelled(documents: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``text`` and its hash ``h`` of the rows to learn from."""
    rows = documents.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    return rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))


def _pack(batch):
    for first, last, data, offsets in slices(batch.column("text"), ROWS):
        kept = (batch.column(name).slice(first, last - first) for name in ("lang", "h"))
        yield pa.record_batch([*kept, pa.array(packed(gram_counts(data, offsets)), pa.binary())], ["lang", "h", "packed"])


def texts_of(documents: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``h`` and the packed counts of all different texts, stored. A copy counts once;
    what is shuffled for that is the counts, not the texts."""
    rows = map_batches(_labelled(documents, text, lang), _pack, "lang string, h bigint, packed binary")
    return stored(rows.dropDuplicates(["lang", "h"]), "language_vectors")


def _summed(texts: DataFrame, each: Callable[[np.ndarray, pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Of the matrices that ``each`` makes of a slice's vectors and rows the sum over all
    slices: within tasks, then by the number of the matrix's row."""

    def partial(batches):
        let_go()
        total = None
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                found = each(unpacked(part.column("packed")), part)
                total = found if total is None else total + found
        if total is not None:
            sums = pa.array([row.tobytes() for row in total.astype(np.float64)], pa.binary())
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), sums], ["k", "sums"])

    def add(table):
        total = sum(np.frombuffer(piece.as_buffer()) for piece in table.column("sums"))
        return pa.table({"k": table.column("k").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    importable(texts)
    schema = "k int, sums binary"
    rows = texts.mapInArrow(partial, schema).groupBy("k").applyInArrow(add, schema).collect()
    return np.stack([np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.k)])


def _calibrates(h: Column) -> Column:
    """A third of the texts, those that the centres are not made of."""
    return F.pmod(h, F.lit(3)) == 1


def _centres(texts: DataFrame, names: list[str]) -> dict[str, np.ndarray]:
    place = {name: k for k, name in enumerate(names)}

    def each(x, part):
        mine = np.array([place[name] for name in part.column("lang").to_pylist()])
        held = part.column("held").to_numpy(zero_copy_only=False)
        out = np.zeros((2 * len(place), x.shape[1]))
        for k in np.unique(2 * mine + held):
            out[k] = x[2 * mine + held == k].sum(axis=0)
        return out

    sums = _summed(texts.withColumn("held", _calibrates(F.col("h"))), each)
    out = {}
    for name, k in place.items():
        # The last column counts; a language that has no other texts is that of the third.
        centre = sums[2 * k if sums[2 * k, -1] else 2 * k + 1]
        centre = (centre[:-1] / centre[-1]).astype(np.float32)
        out[name] = centre / max(float(np.linalg.norm(centre)), 1e-9)
    return out


def calibrate(documents: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> Model:
    """Sets the floors of a model trained on the same documents: of the likeness that the
    calibration third, cut to each size, has to its language, a part of the lower decile.
    Texts of under 32 bytes are too short to be judged."""
    if not model.centres:
        return model
    shared = documents.sparkSession.sparkContext.broadcast(model.centres)

    def likeness(batch):
        centres = shared.value
        for first, last, data, offsets in slices(batch.column("text"), ROWS):
            names = np.array(batch.column("lang").slice(first, last - first).to_pylist(), object)
            hashes, sizes = batch.column("h").slice(first, last - first), np.diff(offsets)
            for c in range(1, 8):
                n = 16 << c
                long = np.flatnonzero(sizes >= n)
                if len(long):
                    cut = data[(offsets[long][:, None] + np.arange(n)).ravel()]
                    x = vectors(cut, np.arange(len(long) + 1) * n)
                    like = [float(v @ centres[name]) for v, name in zip(x, names[long], strict=True)]
                    yield pa.record_batch(
                        [pa.array(names[long], pa.string()), hashes.take(pa.array(long)), pa.array([c] * len(long)), pa.array(like)],
                        ["lang", "h", "c", "v"],
                    )

    rows = _labelled(documents, text, lang).filter(_calibrates(F.col("h")))
    found = map_batches(rows, likeness, "lang string, h bigint, c bigint, v double").dropDuplicates(["lang", "h", "c"])
    # To four digits, so that the different values are few, however many texts there are.
    deciles = found.groupBy("lang", "c").agg(F.percentile(F.round("v", 4), 0.1).alias("v")).collect()
    model.floors = {name: np.zeros(8) for name in model.centres}
    for r in deciles:
        model.floors[r.lang][r.c] = FLOOR * r.v
    return model


class Descent:
    """The way of one machine to its least loss, by limited-memory BFGS: ``at`` is where the
    loss and its slope are asked for next, ``best`` the least found."""

    def __init__(self):
        self.at = self.best = np.zeros(BUCKETS + 1)
        self.loss, self.slope, self.first = np.inf, None, 0.0
        self.move, self.moves, self.done = None, [], False

    def told(self, loss: float, slope: np.ndarray) -> None:
        if self.slope is not None:
            if loss > self.loss + 1e-4 * (self.slope @ self.move):
                # Too far.
                self.move = self.move / 2
                self.at = self.best + self.move
                return
            self.moves = [*self.moves, (self.at - self.best, slope - self.slope)][-MOVES:]
        self.best, self.loss, self.slope = self.at, loss, slope
        size = float(np.linalg.norm(slope))
        self.first = self.first or size
        self.done = size <= DONE * self.first
        self.move = -self._bent(slope)
        self.at = self.best + self.move

    def _bent(self, slope: np.ndarray) -> np.ndarray:
        """The slope times what the moves tell of the inverse of the curvature."""
        if not self.moves:
            return slope / (PENALTY + 4)
        out, parts = slope, []
        for move, turn in reversed(self.moves):
            part = (move @ out) / (move @ turn)
            parts.append(part)
            out = out - part * turn
        move, turn = self.moves[-1]
        out = out * ((move @ turn) / (turn @ turn))
        for (move, turn), part in zip(self.moves, reversed(parts), strict=True):
            out = out + (part - (turn @ out) / (move @ turn)) * move
        return out


def fit(texts: DataFrame, sizes: dict[str, int]) -> Model:
    """Linear machines between families and between the languages of one: squared hinge loss
    with a ridge penalty, both classes of equal weight, over all texts. ``sizes`` has the number
    of texts of each language."""
    names = sorted(sizes)
    families = np.array([family_of(name) for name in names], object)
    # Family names are told apart from languages of the same name.
    model = Model([f"{name} family" for name in sorted(set(families))])
    sides = []

    def duels(members, of):
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                model.pairs[a, b] = len(sides)
                sides.append((of == a) * 1.0 - (of == b))

    duels(model.families, np.array([f"{name} family" for name in families], object))
    for name in model.families:
        model.languages[name] = [n for n, f in zip(names, families, strict=True) if f"{f} family" == name]
        duels(model.languages[name], np.array(names, object))
    if not sides:
        return model
    # A row per language, a column per machine: the side it is on, and the weight of a text.
    side = np.array(sides).T
    many = np.array([sizes[name] for name in names], float)
    share = np.where(side > 0, 0.5 / (many @ (side > 0)), 0.5 / (many @ (side < 0)))
    place = {name: k for k, name in enumerate(names)}
    ways = [Descent() for _ in sides]
    for _ in range(PASSES):
        going = [k for k, way in enumerate(ways) if not way.done]
        if not going:
            break
        asked = np.array([ways[k].at for k in going])
        shared = texts.sparkSession.sparkContext.broadcast((asked.astype(np.float32), side[:, going], share[:, going]))

        def each(x, part, shared=shared):
            weights, side, share = shared.value
            mine = [place[name] for name in part.column("lang").to_pylist()]
            y, s = side[mine], share[mine]
            short = np.where(y == 0, 0, np.maximum(0, 1 - y * (x @ weights.T)))
            slopes = -2 * (s * y * short).T.astype(np.float32) @ x
            return np.hstack([slopes, (s * short**2).sum(axis=0)[:, None]])

        sums = _summed(texts, each)
        shared.destroy()
        for k, w, found in zip(going, asked, sums, strict=True):
            ways[k].told(found[-1] + PENALTY / 2 * (w @ w), found[:-1] + PENALTY * w)
    model.weights = np.array([way.best for way in ways], np.float32)
    return model


def train(documents: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fits on the rows given, all of them; rows without text or language are passed over, and
    of copies with one language one counts."""
    with released(documents.sparkSession):
        texts = texts_of(documents, text, lang)
        sizes = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        if not sizes:
            return Model()
        model = fit(texts, sizes)
        model.centres = _centres(texts, sorted(sizes))
    return model


def predictor(spark, model: Model):
    """The model as a column function: text to a struct of language and score."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(column: pa.Array) -> pa.Array:
        let_go()
        languages, scores = [], []
        model = shared.value
        for first, last, data, offsets in slices(column, ROWS):
            if model.families:
                x = vectors(data, offsets)
                names, sure = model.predict(x)
                if model.floors:
                    sure = np.where(model.strange(x, np.diff(offsets), names), 0.0, sure)
            else:
                names, sure = [UNKNOWN] * (last - first), np.zeros(last - first)
            for i, name in enumerate(names):
                piece = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                known = name if LETTER.search(piece) else UNKNOWN
                languages.append(known)
                scores.append(0.0 if known == UNKNOWN else float(sure[i]))
        return pa.StructArray.from_arrays(
            [pa.array(languages, pa.string()), pa.array(scores, pa.float64())], fields=list(kind)
        )

    return predict


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row, from the text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if
    the model has learned no language. Where the model is calibrated, a text that is unlike
    its language has score 0. Repeated rows get the same answer; an empty table
    stays empty. Columns of the input named like the added ones are replaced.
    """
    importable(documents)
    predict = predictor(documents.sparkSession, model)
    rows = documents.select(*without(documents, ADDED), predict(documents[text]).alias("__found"))
    return rows.select("*", "__found.lang_pred", "__found.score").drop("__found")


def held_out(doc_id: Column) -> Column:
    """The documents a model must not learn from: every third, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))
