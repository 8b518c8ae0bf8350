"""Language identification by blended-spectrum string kernels with Nyström landmarks and ridge regression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches

BITS, LONGEST_GRAM = 16, 4
ROWS_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE, RIDGE = 600, 64, 1e-3
SHARES = 64  # of a language's rows, ranked apart
UNKNOWN = "und"
#: Lengths of the pieces of fitted texts by which texts are judged, parts of the rows that are held out in
#: turn, the share of held-out pieces that may be rejected, and pieces that this is taken from at least.
PIECE_CHARS, PARTS, REJECTED, LEAST_PIECES = (8, 32, 128, 512, 2048), 3, 0.002, 500
#: Grams whose rows of a table of weights are gathered together.
GATHERED = 1 << 17


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """The buckets of all grams of one to four characters that a text holds, each once.

    Case is dropped; whatever is not a letter separates words and counts as one space. A text without
    a letter has none.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 32).astype(np.uint32)
    gap = ~letter
    codes = np.concatenate([[32], codes[~(gap & np.concatenate([[True], gap[:-1]]))], [32]]).astype(np.uint32)
    present = np.zeros(1 << BITS, bool)
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        h = h[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B)
        present[mixed >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(present)


def _sums(table: np.ndarray, found: list[np.ndarray], kind: type = np.float32) -> np.ndarray:
    """The sum of the rows of ``table`` of each text's grams; every text has a gram.

    Texts are taken until they hold ``GATHERED`` grams, so that the rows gathered stay few however many texts there are.
    """
    out, held, n = [], [], 0
    for i, g in enumerate(found):
        held.append(g)
        n += len(g)
        if n >= GATHERED or i + 1 == len(found):
            sizes = np.array([len(x) for x in held])
            out.append(np.add.reduceat(table[np.concatenate(held)], np.cumsum(sizes) - sizes, axis=0, dtype=kind))
            held, n = [], 0
    return np.concatenate(out)


@dataclass
class Model:
    """``weights`` holds, for each bucket and language, what its presence adds before the kernel's norm.

    ``usual`` holds the log of the share of a language's texts with a bucket, ``least`` the least
    usualness of a text with 2^i to 2^(i + 1) buckets; both are None until :meth:`judge_by`.
    """

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    usual: np.ndarray | None = None
    least: np.ndarray | None = None

    @classmethod
    def fit(cls, rows: list[tuple[str, np.ndarray]]) -> Model:
        """One-versus-rest kernel ridge regression on Nyström features.

        The kernel of two texts is the number of grams that both hold, over the root of the product of
        their numbers of grams. Landmarks are the first rows of each language.
        """
        rows = [(language, g) for language, g in rows if len(g)]
        languages = sorted({language for language, _ in rows})
        if not languages:
            return cls([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
        seen: dict[str, int] = {}
        marks = []
        for language, g in rows:
            seen[language] = seen.get(language, 0) + 1
            if seen[language] <= LANDMARKS_PER_LANGUAGE:
                marks.append(g)
        basis = np.zeros((1 << BITS, len(marks)), np.float32)
        for j, g in enumerate(marks):
            basis[g, j] = 1 / np.sqrt(len(g))
        near = np.stack([basis[g].sum(0) / np.sqrt(len(g)) for _, g in rows]).astype(np.float64)
        among = np.stack([basis[g].sum(0) / np.sqrt(len(g)) for g in marks]).astype(np.float64)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        keep = values > 1e-6 * values.max()
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        features = np.concatenate([near @ whiten, np.ones((len(rows), 1))], 1)
        target = np.array([[1.0 if language == x else -1.0 for x in languages] for language, _ in rows])
        share = np.array([seen[language] for language, _ in rows], float)
        balance = (1 / share)[:, None]  # languages count alike
        gram = features.T @ (features * balance) + RIDGE * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, features.T @ (target * balance))
        return cls(languages, basis @ (whiten @ solved[:-1]).astype(np.float32), solved[-1])

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        """Regression values of texts given by their grams: one sparse-by-dense product for the batch."""
        sizes = np.array([len(g) for g in found])
        out = np.full((len(found), len(self.languages)), -1.0)
        full = np.flatnonzero(sizes)
        if len(full) and self.languages:
            sums = _sums(self.weights, [found[i] for i in full])
            out[full] = sums / np.sqrt(sizes[full])[:, None] + self.bias
        return out

    def usualness(self, found: list[np.ndarray], usual: np.ndarray | None = None) -> np.ndarray:
        """The mean log share of the texts of a language that hold a gram of the text, for the language where it is largest."""
        usual = self.usual if usual is None else usual
        sizes = np.array([len(g) for g in found])
        out = np.full(len(found), -np.inf)
        full = np.flatnonzero(sizes)
        if len(full) and self.languages:
            sums = _sums(usual, [found[i] for i in full], np.float64)
            out[full] = (sums / sizes[full][:, None]).max(1)
        return out

    def judge_by(self, rows: list[tuple[str, list[np.ndarray]]]) -> None:
        """Learn which texts are like those of some language, from the grams of whole texts and of pieces of them.

        Each part of the rows is held out in turn and its pieces are measured by the others. A text is
        rejected if all but a few of the held-out pieces of its size are more usual. Too few rows to
        hold any out reject nothing.
        """
        rows = [(language, own) for language, own in rows if len(own[0]) and language in self.languages]
        place = {x: j for j, x in enumerate(self.languages)}
        counts = np.zeros((PARTS, 1 << BITS, len(place)), np.int32)
        n = np.zeros((PARTS, len(place)))
        seen = [0] * len(place)
        part_of = []
        for language, own in rows:
            j = place[language]
            part_of.append(seen[j] % PARTS)
            seen[j] += 1
            counts[part_of[-1], own[0], j] += 1
            n[part_of[-1], j] += 1

        def shares(counts, n):
            return np.log((counts + 0.5) / (n + 1)).astype(np.float32)

        self.usual = shares(counts.sum(0), n.sum(0))
        sizes, values = [], []
        for part in range(PARTS):
            # A row whose language has no row in the other parts says nothing.
            held = [g for (x, own), p in zip(rows, part_of, strict=True) if p == part and seen[place[x]] > n[part, place[x]] for g in own if len(g)]
            if held:
                sizes += [len(g).bit_length() - 1 for g in held]
                values.append(self.usualness(held, shares(counts.sum(0) - counts[part], n.sum(0) - n[part])))
        self.least = np.full(BITS + 1, -np.inf)
        if values:
            sizes, values = np.array(sizes), np.concatenate(values)
            for i in range(BITS + 1):
                away = abs(sizes - i)
                reach = np.sort(away)[min(LEAST_PIECES, len(away)) - 1]  # sizes nearby, until there are enough
                self.least[i] = np.quantile(values[away <= reach], REJECTED, method="lower")

    def accepts(self, found: list[np.ndarray]) -> np.ndarray:
        """Whether each text has a gram and is like texts of a language."""
        sizes = np.array([len(g) for g in found], int)
        least = self.least[np.maximum(0, np.frexp(sizes)[1] - 1)]
        return (sizes > 0) & bool(self.languages) & (self.usualness(found) >= least)


def pieces(text: str, place: int) -> list[str]:
    """The text, and a piece of it of each length of PIECE_CHARS that is shorter."""
    starts = [(place * 7919) % (len(text) - n + 1) for n in PIECE_CHARS if n < len(text)]
    return [text, *(text[at : at + n] for at, n in zip(starts, PIECE_CHARS, strict=False))]


def _gram_rows(docs: DataFrame, cut: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lang, text, place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = [grams(t).astype("<u2").tobytes() for t in (pieces(text, place) if cut else [text])]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([place], pa.int32()), pa.array([found], pa.list_(pa.binary()))], ["lang", "place", "grams"])

    return docs.select("lang", "text", "place").mapInArrow(run, "lang string, place int, grams array<binary>")


def train(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, judges: bool = False) -> Model:
    """A model from (doc_id, text, lang); null languages and texts are left out.

    At most ``rows_per_language`` texts of each language are used, those with the smallest MD5; a text counts once
    however often it is there. Only their sets of grams reach the driver. With ``judges`` the model also learns
    which texts are like none of the languages. Other columns are not read, whatever their names.
    """
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    known = known.select("lang", "text", F.md5(F.col("text").cast("binary")).alias("key"))
    # Ranked within shares of a language first, so that no task meets all texts of one language.
    share = Window.partitionBy("lang", "share").orderBy("key")
    chosen = known.select("lang", "key").distinct().withColumn("share", F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(SHARES)))
    chosen = chosen.withColumn("place", F.row_number().over(share)).filter(F.col("place") <= rows_per_language)
    whole = Window.partitionBy("lang").orderBy("key")
    chosen = chosen.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= rows_per_language)
    # At most rows_per_language rows for each language: a bound on what is broadcast.
    chosen = F.broadcast(chosen.select(F.col("lang").alias("lang2"), F.col("key").alias("key2"), "place"))
    rows = known.join(chosen, (F.col("lang") == F.col("lang2")) & (F.col("key") == F.col("key2")))
    rows = rows.groupBy("lang", "place").agg(F.min("text").alias("text"))  # copies are one row again
    got = sorted((r.lang, r.place, r.grams) for r in _gram_rows(rows, judges).collect())
    # Two bytes a gram, as they came: the grams of all rows and their pieces are held here together.
    fitted = [(lang, [np.frombuffer(g, "<u2") for g in own]) for lang, _, own in got]
    model = Model.fit([(lang, own[0]) for lang, own in fitted])
    if judges:
        model.judge_by(fitted)
    return model


def in_a_language(docs: DataFrame, model: Model, name: str | None = None) -> DataFrame:
    """The rows of ``docs`` (text, ...) whose text the model accepts; null texts and texts without a letter go.

    With ``name``, that column of ``docs`` becomes the language of the text, as :func:`predict` finds it.
    """
    place = docs.columns.index("text")
    at = None if name is None else docs.columns.index(name)

    def run(batches):
        for batch in batches:
            texts = batch.column(place)
            kept, langs = [], []
            for _, part in text_batches([pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], ["id", "text"])]):
                found = [grams(t) for t in part]
                kept += model.accepts(found).tolist()
                if at is not None:
                    langs += [model.languages[best] for best in model.score(found).argmax(1)] if model.languages else [None] * len(part)
            if at is not None:
                batch = batch.set_column(at, name, pa.array(langs, pa.string()).cast(batch.schema.field(at).type))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with lang_pred and score (0 to 1) added; other columns are kept, but ones of these names are replaced.

    A null text, a text without a letter and a model without languages give ``und`` and score 0. Ties
    go to the first language in alphabetical order. Long texts are met whole.
    """
    docs = docs.drop("lang_pred", "score")
    place = docs.columns.index("text")
    names = [*docs.columns, "lang_pred", "score"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for batch in batches:
            texts = batch.column(place)
            langs, scores = [], []
            for _, part in text_batches([pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], ["id", "text"])]):
                found = [grams(t) for t in part]
                values = model.score(found)
                for g, v in zip(found, values, strict=True):
                    best = int(v.argmax()) if len(g) and len(v) else -1
                    langs.append(model.languages[best] if best >= 0 else UNKNOWN)
                    scores.append(float(min(1.0, max(0.0, (1 + v[best]) / 2))) if best >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")
