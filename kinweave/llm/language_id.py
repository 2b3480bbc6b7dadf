"""Language ID by segmentation-marginalised unigrams.

A word (a run of non-blank bytes, with a blank before it) is a sequence of pieces of a fixed
public vocabulary.  A language gives every piece a probability; the score of a word sums the
probabilities of all its segmentations, by a forward pass over its bytes, and a text scores
the sum of its words' logarithms.  Piece probabilities come from expectation maximisation
over the same segmentations, on a bounded sample of the labelled documents.

Both passes run over the different words of a batch at once, a byte position at a time.
"""

from __future__ import annotations

import base64
import collections
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import BLANKS, WORD, held_out, ship
from kinweave.llm.textvec import LOWER, Spans, give_back, row_sums, slices, texts, words
from kinweave.llm.tokens import Known, grown, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Documents of each language the model is fitted on, about.
SAMPLE = 300
REMEMBERED = 300_000
UNDETERMINED = "und"


@functools.cache
def pieces(path: str) -> list[bytes]:
    """The pieces of the vocabulary file, lower-cased, but those that no word can hold, as they
    have a blank after their first byte; every byte is one."""
    with open(path, "rb") as file:
        every = {base64.b64decode(line.split()[0]).lower() for line in file}
    blank = set(BLANKS.encode())
    return sorted({p for p in every if blank.isdisjoint(p[1:])} | {bytes([b]) for b in range(256)})


class Lookup:
    """Row numbers of pieces by the hash of their bytes: two probes of a sparse table."""

    BITS = 18

    def __init__(self, every: list[bytes]):
        data = np.frombuffer(b"".join(every), np.uint8)
        ends = np.cumsum([len(p) for p in every])
        hashes = Spans(data).hash(np.append(0, ends[:-1]), ends)
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.rows = np.full(1 << self.BITS, len(every), np.int32)
        for row, h in enumerate(hashes.tolist()):
            at = h >> (64 - self.BITS)
            while self.rows[at] != len(every):
                at = (at + 1) % (1 << self.BITS)
            self.keys[at], self.rows[at] = h, row
        self.none = len(every)
        self.sizes = np.unique([len(p) for p in every])
        taken = self.rows != self.none
        edges = np.flatnonzero(np.diff(np.concatenate([[0], taken.astype(np.int8), [0]])))
        self.reach = int((edges[1::2] - edges[::2]).max())

    def find(self, hashes: np.ndarray) -> np.ndarray:
        return self._find(hashes.ravel()).reshape(hashes.shape)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.where(self.keys[at] == hashes, self.rows[at], self.none)
        open_ = np.flatnonzero((out == self.none) & (self.rows[at] != self.none))
        for step in range(1, self.reach + 1):
            if not len(open_):
                break
            next_ = (at[open_] + step) % (1 << self.BITS)
            out[open_] = np.where(self.keys[next_] == hashes[open_], self.rows[next_], self.none)
            open_ = open_[(out[open_] == self.none) & (self.rows[next_] != self.none)]
        return out


@functools.cache
def lookup(path: str) -> Lookup:
    return Lookup(pieces(path))


class Lattice:
    """All pieces that end at each byte of some words; words in order of falling length."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: Lookup):
        """`data` is lower-cased, with a blank before every word."""
        self.order = np.argsort(starts - ends, kind="stable")
        self.starts, self.sizes = starts[self.order], (ends - starts)[self.order]
        self.none, self.spans, self.table = table.none, Spans(data), table

    def active(self, place: int) -> int:
        """How many words have `place` bytes or more."""
        return int(np.searchsorted(-self.sizes, -place, "right"))

    def at(self, place: int, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, words, rows): which of the first `n` words have a piece of that size that ends at `place`."""
        ends = self.starts[:n] + place
        sizes = self.table.sizes[: np.searchsorted(self.table.sizes, place, "right")]
        begins = ends - sizes[:, None]
        found = self.table.find(self.spans.hash(begins, np.broadcast_to(ends, begins.shape)))
        for k in np.flatnonzero((found != self.none).any(axis=1)).tolist():
            some = np.flatnonzero(found[k] != self.none)
            yield int(sizes[k]), some, found[k][some]


def _forward(lattice: Lattice, chance: np.ndarray, keep: bool = False):
    """(log of each word's probability in each language, in the lattice's order; what `_expected` needs).

    `chance` is (pieces + 1, languages), 0 in its last row.  Values are scaled on the way, so
    words may have any length; those of as many places are held as the longest piece has bytes.
    """
    count, width = len(lattice.sizes), chance.shape[1]
    past = collections.deque([np.ones((count, width))], maxlen=int(lattice.table.sizes[-1]))
    logs, steps = np.zeros((count, width)), [(np.ones(count), np.zeros(count))]
    out = np.zeros((count, width))
    for place in range(1, int(lattice.sizes.max(initial=0)) + 1):
        n = lattice.active(place)
        now = np.zeros((n, width))
        for size, some, rows in lattice.at(place, n):
            now[some] += past[-size][some] * chance[rows]
        # Each language by itself is brought back to a common scale before it gets too small.
        if place % 16 == 0 or (now < 1e-30).any():
            scale = np.where(now > 0, now, 1.0)
            for before in past:
                before[:n] /= scale
            now /= scale
            logs[:n] += np.log(scale)
        past.append(now)
        done = lattice.active(place + 1)
        with np.errstate(divide="ignore"):
            out[done:n] = np.log(now[done:n]) + logs[done:n]
        if keep:
            steps.append((now[:, 0].copy(), logs[:n, 0].copy()))
    return out, steps


def word_scores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: Lookup, chance: np.ndarray) -> np.ndarray:
    lattice = Lattice(data, starts, ends, table)
    out = np.empty((len(starts), chance.shape[1]))
    out[lattice.order] = _forward(lattice, chance)[0]
    return out


def _expected(lattice: Lattice, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, for one language.

    `backward` is on the scale of the forward values at its place, so that their product is
    the chance, times the word's weight, of a cut there.
    """
    _, steps = _forward(lattice, chance, keep=True)
    backward = [np.zeros(len(forward)) for forward, _ in steps]
    counts = np.zeros(len(chance))
    weight = weight[lattice.order]
    for place in range(len(steps) - 1, 0, -1):
        (forward, log), back = steps[place], backward[place]
        n, done = len(forward), lattice.active(place + 1)
        back[done:n] = weight[done:n] / np.maximum(forward[done:n], 1e-300)
        for size, some, rows in lattice.at(place, n):
            before, log_before = steps[place - size]
            use = back[some] * chance[rows, 0] * np.exp(log_before[some] - log[some])
            counts += np.bincount(rows, use * before[some], len(chance))
            backward[place - size][some] += use
        backward[place] = np.zeros(0)
    return counts


@dataclass
class Model:
    languages: list[str]
    chance: np.ndarray  # (pieces + 1, languages)
    prior: np.ndarray
    path: str


def _spaced(every: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(b" " + w for w in every), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in every])
    return data, np.append(0, ends[:-1]).astype(np.int64), ends


def fit(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE, rounds: int = 4, smoothing: float = 0.1) -> Model:
    """Piece probabilities of every language that a document to learn from has.

    About `sample` documents of each language are drawn by a hash of their ids, and their
    words counted by Spark; the driver gets those counts and nothing else.
    """
    path = path or vocabulary_path(VOCABULARY)
    known = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(lang).alias("l"), F.col(text).alias("t"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("h"))
    totals = {r.l: r.n for r in known.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros((len(pieces(path)) + 1, 0)), np.zeros(0), path)
    share = F.coalesce(*[F.when(F.col("l") == x, F.lit(min(1.0, sample / totals[x]))) for x in languages])
    drawn = known.where(F.col("h") < share * (1 << 30))
    lower = F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    word = F.explode(F.regexp_extract_all(lower, F.lit(f"({WORD})"), 1))
    counts = drawn.select("l", word.alias("w")).groupBy("l", "w").count().toPandas()
    table, size = lookup(path), len(pieces(path))
    chance = np.zeros((size + 1, len(languages)))
    for i, language in enumerate(languages):
        own = counts[counts["l"] == language]
        lattice = Lattice(*_spaced([w.encode() for w in own["w"]]), table)
        weight = own["count"].to_numpy(float)
        p = np.full((size + 1, 1), 1 / size)
        p[-1] = 0
        for _ in range(rounds if len(own) else 0):
            uses = _expected(lattice, p, weight)[:-1] + smoothing
            p[:-1, 0] = uses / uses.sum()
        chance[:, i] = p[:, 0]
    prior = np.log(np.array([totals[x] for x in languages], float) / sum(totals.values()))
    return Model(languages, chance, prior, path)


class Scorer:
    """Log-probabilities of texts; remembers the words that it has seen."""

    def __init__(self, model: Model):
        self.model, self.table = model, lookup(model.path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.scores = Known(), np.zeros((1 << 14, len(self.model.languages)), np.float32)

    def score(self, column: pa.Array) -> np.ndarray:
        data, offsets = texts(column)
        data = LOWER[data]
        starts, ends, row = words(data, offsets)
        if not len(starts):
            return np.zeros((len(column), len(self.model.languages)))
        codes, hashes = pd.factorize(Spans(data).hash(starts, ends))
        if len(self.known) > REMEMBERED:
            self._forget()
        place = self.known.find(hashes)
        new = np.flatnonzero(place < 0)
        if len(new):
            one = np.zeros(len(hashes), np.int64)
            one[codes[::-1]] = np.arange(len(codes))[::-1]
            raw = data.tobytes()
            spans = zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)
            rows = self.known.add(hashes[new])
            self.scores = grown(self.scores, len(self.known))
            self.scores[rows] = word_scores(*_spaced([raw[a:b] for a, b in spans]), self.table, self.model.chance)
            place[new] = rows
        per_word = self.scores[place[codes]].astype(np.float64)
        return row_sums(per_word, np.bincount(row, minlength=len(column)))


def identify(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column (lang_pred, score) for `docs`, from the whole text.

    The score is the probability of the predicted language among those learned.  `und` with
    score 0 where the text is NULL or has no letter, or nothing was learned.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages: a fixed size
    empty = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.languages:
        return empty

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value)  # of this task: an idle worker holds no words
        for column in batches:
            chosen, chances = [], []
            for part in slices(pa.RecordBatch.from_arrays([column], names=["t"]), "t", 1 << 18):
                logs = scorer.score(part.column("t")) + scorer.model.prior
                best = logs.max(axis=1)
                chosen.append(logs.argmax(axis=1))
                chances.append(1 / np.exp(logs - best[:, None]).sum(axis=1))
            names = np.array(scorer.model.languages, object)[np.concatenate(chosen)] if chosen else []
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(chances) if chances else [], pa.float64())],
                ["lang_pred", "score"],
            )
        del scorer
        give_back()

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    scored = F.arrow_udf(predict, "lang_pred string, score double")
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return F.when(lettered, scored(F.coalesce(F.col(text), F.lit("")))).otherwise(empty)


def tag_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", model: Model | None = None) -> DataFrame:
    """key, held_out, lang_pred and score of every row.

    Defined cases: NULL and letterless texts are `und`; a NULL key counts as held out; a NULL
    language is not learned; a text equally likely in two languages gets the first by
    name; repeated rows are tagged alike; an empty table gives no rows.
    """
    model = model or fit(docs, key=key, text=text, lang=lang)
    tagged = docs.select(F.col(key).alias("_key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    tagged = tagged.withColumn("_tag", identify(tagged, model, "_text"))
    return tagged.select(F.col("_key").alias(key), "held_out", "_tag.lang_pred", "_tag.score")
