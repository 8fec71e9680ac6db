"""Language identification: unigrams of pieces, marginalised over segmentations.

The pieces are those of a fixed public vocabulary. Each language gives each piece a
probability, and a word the sum over all its segmentations of their pieces' products, which
a forward pass computes. Probabilities are learned by expectation maximisation, whose
expected counts come from a backward pass over the same lattice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import beside, keep, row_key, struct, text_blocks

UNKNOWN_LANGUAGE = "und"
TRAINING_DOCS = 300  # of each language
ROUNDS = 2
SMOOTHING = 0.05
SEED = 7
MARK = "▁"  # stands before a word's first letter in the vocabulary
SHORT = 32  # characters with the mark; the products of longer words are kept in range by scaling
RESCALED = 8  # places of a long word between two scalings
TINY = 1e-300
WORDS_AT_ONCE = 5_000
LONG_AT_ONCE = 512
PLACES_AT_ONCE = 4_096  # of all long words read together
TABLE_BITS = 17
TABLE = 1 << TABLE_BITS
FACTOR, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
KNOWN_WORDS = 200_000
KNOWN_CHARACTERS = 8_000_000
DOCS_AT_ONCE = 1_024
LETTER = regex.compile(r"\p{L}")


class Pieces:
    """A vocabulary's text pieces in a hash table that answers for whole arrays at once.

    A substring is known by its length and a 64-bit rolling hash. Id 0 stands for any other
    single character.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        no_text = (model.is_control, model.is_unknown, model.is_byte)
        texts = {model.id_to_piece(i): i for i in range(model.vocab_size()) if not any(f(i) for f in no_text)}
        self.size = max(texts.values()) + 1
        self.longest = max(map(len, texts))
        self.powers = np.r_[np.uint64(1), np.full(self.longest, FACTOR).cumprod(dtype=np.uint64)]
        self.keys = np.zeros(TABLE, np.uint64)
        self.ids = np.full(TABLE, -1, np.int64)
        for text, number in texts.items():
            key = self.hashes([text])[:, -1] + np.uint64(len(text))
            at = int(self.slot(key)[0])
            while self.ids[at] >= 0:
                at = (at + 1) % TABLE
            self.keys[at], self.ids[at] = key[0], number

    @staticmethod
    def slot(key: np.ndarray) -> np.ndarray:
        return ((key ^ (key >> np.uint64(31))) * MIX >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    @staticmethod
    def hashes(words: list[str]) -> np.ndarray:
        """Hash of each prefix of words of one length, the empty one first."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        out = np.zeros((len(words), codes.shape[1] + 1), np.uint64)
        for i in range(codes.shape[1]):
            out[:, i + 1] = out[:, i] * FACTOR + codes[:, i]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the keys, -1 where there is no such piece."""
        at = self.slot(keys)
        found = np.where(self.keys[at] == keys, self.ids[at], -1)
        open_ones = np.nonzero((found < 0) & (self.ids[at] >= 0))
        place = at[open_ones]
        while len(place):
            place = (place + 1) % TABLE
            same = self.keys[place] == keys[open_ones]
            found[tuple(x[same] for x in open_ones)] = self.ids[place[same]]
            more = ~same & (self.ids[place] >= 0)
            open_ones, place = tuple(x[more] for x in open_ones), place[more]
        return found

    def lattice(self, words: list[str]) -> Iterator[tuple[np.ndarray, int, list[tuple[int, np.ndarray]]]]:
        """Words of one length at a time, with the pieces that end at each place: the first
        start and, word by start, their ids, -1 where there is none."""
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, rows in by_length.items():
            for at in range(0, len(rows), WORDS_AT_ONCE):
                some = rows[at : at + WORDS_AT_ONCE]
                prefixes, ends = self.hashes([words[i] for i in some]), []
                for end in range(1, length + 1):
                    low = max(0, end - self.longest)
                    sizes = np.arange(end - low, 0, -1)
                    keys = prefixes[:, end, None] - prefixes[:, low:end] * self.powers[sizes] + sizes.astype(np.uint64)
                    ids = self.find(keys)
                    np.maximum(ids[:, -1], 0, out=ids[:, -1])
                    ends.append((low, ids))
                yield np.array(some), length, ends

    def ending(self, prefixes: np.ndarray, first: int, last: int) -> np.ndarray:
        """Ids of the pieces that end at the places after `first` up to `last` of words given by the
        hashes of their prefixes: word by place by start, the longest piece first."""
        sizes = np.arange(self.longest, 0, -1)
        ends = np.arange(first + 1, last + 1)[:, None]
        starts = np.maximum(ends - sizes, 0)
        keys = prefixes[:, ends] - prefixes[:, starts] * self.powers[sizes] + sizes.astype(np.uint64)
        ids = np.where(ends >= sizes, self.find(keys), -1)
        np.maximum(ids[:, :, -1], 0, out=ids[:, :, -1])
        return ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    """One table per worker process."""
    return Pieces(path)


def forward(many: int, ends: list[tuple[int, np.ndarray]], chance: np.ndarray) -> np.ndarray:
    """Summed products of all segmentations up to each place; the last row of `chance` is zero,
    which is what a missing piece gets."""
    alpha = np.zeros((many, len(ends) + 1, chance.shape[1]))
    alpha[:, 0] = 1
    for end, (low, ids) in enumerate(ends, 1):
        alpha[:, end] = (alpha[:, low:end] * chance[ids]).sum(axis=1)
    return alpha


class LongWords:
    """Words of some length read together, a stretch of places at a time.

    A place needs the sums of no more places before it than the longest piece has characters.
    Those are kept, scaled by word and language, from one stretch to the next, so memory does not
    grow with the words beyond their prefixes' hashes. Shorter words are filled up; what lies
    after a word's end is not read.
    """

    def __init__(self, pieces: Pieces, words: list[str], chance: np.ndarray):
        self.pieces, self.chance = pieces, chance
        self.lengths = np.array([len(w) for w in words])
        most = int(self.lengths.max())
        self.prefixes = pieces.hashes([w.ljust(most, "\0") for w in words])
        step = max(RESCALED, PLACES_AT_ONCE // len(words))
        self.stretches = [(at, min(at + step, most)) for at in range(0, most, step)]
        # The sums at the last places, the empty beginning being certain, and their scale.
        window = np.zeros((len(words), pieces.longest, chance.shape[1]))
        window[:, -1] = 1
        self.start = window, np.zeros((len(words), chance.shape[1]))

    def advance(self, state: tuple, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
        """Ids and chances of the pieces that end in a stretch, logarithms of the sums up to its
        places, and the state after it."""
        ids = self.pieces.ending(self.prefixes, first, last)
        chances = self.chance[ids]
        (window, scale), longest = state, self.pieces.longest
        line = np.concatenate([window, np.empty((len(ids), last - first, window.shape[2]))], axis=1)
        sums, scales = np.empty_like(line[:, longest:]), np.empty_like(line[:, longest:])
        for i in range(last - first):
            sums[:, i] = line[:, i + longest] = (line[:, i : i + longest] * chances[:, i]).sum(axis=1)
            scales[:, i] = scale
            if i % RESCALED == RESCALED - 1:
                recent = line[:, i + 1 : i + 1 + longest]
                top = recent.max(axis=1)
                recent /= top[:, None]
                scale = scale + np.log(top)
        return ids, chances, np.log(sums) + scales, (line[:, last - first :].copy(), scale)

    def ended(self, first: int, last: int) -> np.ndarray:
        return np.nonzero((self.lengths > first) & (self.lengths <= last))[0]

    def scores(self) -> np.ndarray:
        """Logarithm of each word's probability in each language."""
        out, state = np.zeros(self.start[1].shape), self.start
        for first, last in self.stretches:
            _, _, logs, state = self.advance(state, first, last)
            done = self.ended(first, last)
            out[done] = logs[done, self.lengths[done] - first - 1]
        return out

    def expected(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of pieces and how often each is expected by language, in words seen `counts` times.

        How often a place is passed is divided among the pieces that end there, by their part of
        the sum up to it, from the last place back. Only sums of near places are compared.
        """
        states = [self.start]
        for stretch in self.stretches[:-1]:
            states.append(self.advance(states[-1], *stretch)[3])
        longest = self.pieces.longest
        carried = np.zeros_like(self.start[0])
        for (first, last), state in zip(self.stretches[::-1], states[::-1], strict=True):
            ids, chances, logs, _ = self.advance(state, first, last)
            with np.errstate(divide="ignore"):
                line = np.concatenate([np.log(state[0]) + state[1][:, None], logs], axis=1)
            before = np.lib.stride_tricks.sliding_window_view(line[:, :-1], longest, axis=1)
            shares = chances * np.exp(before.transpose(0, 1, 3, 2) - logs[:, :, None])
            passed = np.zeros_like(line)
            passed[:, last - first :] += carried
            done = self.ended(first, last)
            passed[done, longest + self.lengths[done] - first - 1] += counts[done]
            for i in range(last - first - 1, -1, -1):
                shares[:, i] *= passed[:, i + longest, None]
                passed[:, i : i + longest] += shares[:, i]
            carried = passed[:, :longest]
            has = ids >= 0
            yield ids[has], shares[has]


def by_size(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the short words, and of the long ones in groups of similar length."""
    sizes = np.array([len(w) for w in words], np.int64)
    long = np.nonzero(sizes > SHORT)[0]
    groups: list[list[int]] = []
    for i in long[np.argsort(sizes[long], kind="stable")]:
        if not groups or len(groups[-1]) == LONG_AT_ONCE or sizes[i] > 1.5 * sizes[groups[-1][0]]:
            groups.append([])
        groups[-1].append(i)
    return np.nonzero(sizes <= SHORT)[0], [np.array(g) for g in groups]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    chance: np.ndarray  # piece by language, and a row of zeros
    path: str

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Logarithm of each word's probability in each language."""
        marked = [MARK + w for w in words]
        out = np.zeros((len(words), len(self.languages)))
        pieces = vocabulary(self.path)
        short, groups = by_size(marked)
        for rows, length, ends in pieces.lattice([marked[i] for i in short]):
            out[short[rows]] = np.log(np.maximum(forward(len(rows), ends, self.chance)[:, length], TINY))
        for group in groups:
            out[group] = LongWords(pieces, [marked[i] for i in group], self.chance).scores()
        return out


def expected_batches(
    batches: Iterator[pa.RecordBatch], languages: int, chance: np.ndarray | None, path: str
) -> Iterator[pa.RecordBatch]:
    """Words with their counts by language to expected counts of pieces by language. Without
    chances yet, all pieces are equally likely."""
    pieces = vocabulary(path)
    if chance is None:
        chance = np.r_[np.full((pieces.size, languages), 1 / pieces.size), np.zeros((1, languages))]
    total = np.zeros((pieces.size, languages))
    for batch in batches:
        marked = [MARK + w for w in batch.column(0).to_pylist()]
        counts = np.array(batch.column(1).to_pylist(), float).reshape(-1, languages)
        short, groups = by_size(marked)
        for group in groups:
            for used, shares in LongWords(pieces, [marked[i] for i in group], chance).expected(counts[group]):
                for k in range(languages):
                    total[:, k] += np.bincount(used, shares[:, k], pieces.size)
        for rows, length, ends in pieces.lattice([marked[i] for i in short]):
            alpha = forward(len(rows), ends, chance)
            beta = np.zeros_like(alpha)
            beta[:, length] = counts[short[rows]] / np.maximum(alpha[:, length], TINY)
            used, shares = [], []
            for end in range(length, 0, -1):
                low, ids = ends[end - 1]
                there = beta[:, end, None] * chance[ids]
                beta[:, low:end] += there
                has = ids >= 0
                used.append(ids[has])
                shares.append((alpha[:, low:end] * there)[has])
            used, shares = np.concatenate(used), np.concatenate(shares)
            for k in range(languages):
                total[:, k] += np.bincount(used, shares[:, k], pieces.size)
    piece, language = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece), pa.array(language), pa.array(total[piece, language])], names=["piece", "language", "expected"]
    )


def train(docs: DataFrame, path: str, id_col: str, text_col: str, lang_col: str, most: int, rounds: int) -> Model:
    """Fit on the first `most` documents of each language by a hash of their ids. Words are
    counted, and expected counts summed, by Spark; the driver gets one number for each
    piece and language, from the fixed vocabulary."""
    rank = Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col, F.lit(SEED)), id_col)
    chosen = docs.where(F.col(lang_col).isNotNull()).select(id_col, lang_col)
    chosen = chosen.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= most)
    chosen = chosen.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")).distinct()
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))
    words = rows.select("_lang", F.explode(F.regexp_extract_all(text_col, F.lit(r"([^\x20\x09-\x0D]+)"))).alias("word"))
    counted = keep(words.groupBy("word", "_lang").count(), "words")
    languages = sorted(r._lang for r in counted.select("_lang").distinct().collect())
    size, chance = vocabulary(path).size, None
    if languages:
        of = [F.coalesce(F.sum(F.when(F.col("_lang") == x, F.col("count"))), F.lit(0)) for x in languages]
        table = counted.groupBy("word").agg(F.array(*of).alias("counts"))
        table = keep(table.repartition(docs.sparkSession.sparkContext.defaultParallelism), "words")
        for _ in range(rounds):
            work = partial(expected_batches, languages=len(languages), chance=chance, path=path)
            sums = table.mapInArrow(work, "piece long, language long, expected double")
            found = np.zeros((size, len(languages)))
            for r in sums.groupBy("piece", "language").agg(F.sum("expected").alias("n")).collect():
                found[r.piece, r.language] = r.n
            found = (found + SMOOTHING) / (found.sum(axis=0) + SMOOTHING * size)
            chance = np.r_[found, np.zeros((1, len(languages)))]
    return Model(languages, chance if chance is not None else np.zeros((size + 1, 0)), path)


class Reader:
    """Scores texts under a model, remembering words."""

    def __init__(self, model: Model):
        self.model, self.known, self.characters = model, {}, 0
        self.scores = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        new = sum(map(len, fresh))
        if len(self.known) + len(fresh) > KNOWN_WORDS or self.characters + new > KNOWN_CHARACTERS:
            fresh = list(words)
            new, self.characters = sum(map(len, fresh)), 0
            self.known.clear()
            self.scores = self.scores[:0]
        self.characters += new
        first = len(self.known)
        self.known.update(zip(fresh, range(first, first + len(fresh))))
        self.scores = np.vstack([self.scores, self.model.word_scores(fresh)])

    def read(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and its share of the probability of each text, all languages being equally
        likely beforehand."""
        total = np.zeros((len(texts), len(self.model.languages)))
        pending: list[tuple[int, list[str]]] = []
        seen: set[str] = set()

        def flush() -> None:
            self.learn(seen)
            for i, words in pending:
                total[i] += self.scores[list(map(self.known.__getitem__, words))].sum(axis=0)
            pending.clear()
            seen.clear()

        for i, text in enumerate(texts):
            for block in text_blocks((text or "").encode()):
                words = [w.decode() for w in block.split()]
                pending.append((i, words))
                seen.update(words)
                if len(seen) > KNOWN_WORDS // 4:
                    flush()
        flush()
        out = []
        for text, row in zip(texts, total, strict=True):
            if not text or not len(row) or not LETTER.search(text):
                out.append((UNKNOWN_LANGUAGE, 0.0))
                continue
            share = np.exp(row - row.max())
            out.append((self.model.languages[int(row.argmax())], float(1 / share.sum())))
        return out


def read_batches(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    reader = Reader(model)
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            found = reader.read(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                schema=schema,
            )


def languages_of(
    docs: DataFrame,
    path: str,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = TRAINING_DOCS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per input row: id, `lang_pred`, `score`.

    `path` is a sentencepiece vocabulary on every node. The model is fitted on at most
    `most` documents of each language among the rows where `learn` holds and the language is
    known; then every whole text is scored in one pass without a shuffle. Words are read one
    by one and whole, however long. `score` is the share of the predicted
    language in the text's probability.

    A text that is null or has no letter, and every text if nothing could be learned, is
    `und` with score 0. Of equally likely languages the first by name is taken. Repeated
    rows repeat their result; other columns are not read; an empty table gives an empty
    result.
    """
    taught = docs if learn is None else docs.where(learn)
    return read_rows(docs, train(taught, path, id_col, text_col, lang_col, most, rounds), id_col, text_col)


def read_rows(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, `lang_pred`, `score`."""
    schema = struct(**{id_col: docs.schema[id_col].dataType}, lang_pred=T.StringType(), score=T.DoubleType())
    work = partial(read_batches, model=model, schema=to_arrow_schema(schema))
    return docs.select(id_col, text_col).mapInArrow(work, schema)


def drop_unknown_languages(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    least: float = 0.5,
    learn: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = TRAINING_DOCS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The rows of `docs` in a learned language, read with a score of `least` or more, with
    all their columns. Each row is judged by its own text, whatever others share its id."""
    taught = docs if learn is None else docs.where(learn)
    model = train(taught, path, id_col, text_col, lang_col, most, rounds)
    rows = beside(docs, key=row_key(id_col, text_col), text=F.col(text_col))
    read = read_rows(rows, model, "key", "text")
    known = read.where((F.col("lang_pred") != UNKNOWN_LANGUAGE) & (F.col("score") >= least))
    known = known.select(F.col("key").alias("known")).distinct()
    return rows.join(known, F.col("key") == F.col("known"), "left_semi").select("row.*")
