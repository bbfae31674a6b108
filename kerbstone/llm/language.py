"""Language identification with string kernels.

Two texts are alike as far as they hold the same character n-grams, whichever
their number: for each order the shared n-grams over the root of both counts,
blended over the orders. A Nyström approximation with a few landmark texts
makes that kernel finite, and one-versus-rest ridge regression on it is solved
once on the driver. Scoring is two matrix products for each batch: texts by
landmarks, landmarks by languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns
from kerbstone.plans.cut import cut

#: Bits of the presence table of each order of n-grams: 1, 2 and 3 characters.
ORDER_BITS = (12, 15, 17)
#: Labelled rows that are learned from, for each language at most, and in all (two of a language at least).
TRAIN_PER_LANG, TRAIN_ROWS = 300, 8192
#: Landmarks among them, of a language at most and in all (one of a language at least).
LANDMARKS_PER_LANG, LANDMARKS = 48, 1024
#: Bytes of the landmarks' matrix, which is sent to the tasks (one landmark of a language at least).
LANDMARK_BYTES = 256 << 20
RIDGE = 1e-2
#: Texts of one matrix product, and characters hashed at once.
BATCH, PART_CHARS = 64, 1 << 20

UNKNOWN = "und"
NO_LETTERS = regex.compile(r"\P{L}+")
TABLE = sum(1 << b for b in ORDER_BITS)


def letters(text: str) -> str:
    """A text's letters (Unicode category L), lower-cased, with a space for all between them."""
    return NO_LETTERS.sub(" ", text.lower()).strip()


def presence(text: str) -> np.ndarray | None:
    """Which hashed n-grams a text's letters make; nothing if it has no letter."""
    shown = letters(text)
    if not shown:
        return None
    found = np.zeros(TABLE, dtype=bool)
    for at in range(0, len(shown), PART_CHARS):
        part = f" {shown[at:at + PART_CHARS + 2]} "
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        first = 0
        for order, bits in enumerate(ORDER_BITS):
            gram = np.zeros(len(codes) - order, dtype=np.uint32)
            for i in range(order + 1):
                gram = gram * np.uint32(0x01000193) + codes[i:len(codes) - order + i]
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x9E3779B1)
            found[first + (mixed >> np.uint32(32 - bits))] = True
            first += 1 << bits
    return found


def scales(found: np.ndarray) -> list[float]:
    """For each order, one over the root of its number of n-grams."""
    out, first = [], 0
    for bits in ORDER_BITS:
        n = np.count_nonzero(found[first:first + (1 << bits)])
        out.append(1 / np.sqrt(max(n, 1) * len(ORDER_BITS)))
        first += 1 << bits
    return out


def order_of(columns: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.cumsum([1 << b for b in ORDER_BITS]), columns, "right")


@dataclass
class Model:
    """Landmarks over the n-grams that any of them has, and the weights of languages."""

    langs: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def rows(self, tables: list[np.ndarray]) -> np.ndarray:
        order = order_of(self.columns)
        return np.stack([
            t[self.columns] * np.array(scales(t), dtype=np.float32)[order] for t in tables
        ]).astype(np.float32)

    def kernel(self, tables: list[np.ndarray]) -> np.ndarray:
        return self.rows(tables) @ self.landmarks.T

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return langs, scores
        for at in range(0, len(texts), BATCH):
            # a presence table is much larger than its text: a batch of them at once
            found = [(at + i, presence(text)) for i, text in enumerate(texts[at:at + BATCH])]
            part = [(i, t) for i, t in found if t is not None]
            if not part:
                continue
            values = self.kernel([t for _, t in part]) @ self.weights
            for (i, _), row in zip(part, values):
                best = int(row.argmax())
                langs[i] = self.langs[best]
                scores[i] = float(min(1.0, max(0.0, (row[best] + 1) / 2)))
        return langs, scores


def unpacked(tables: list[np.ndarray]) -> list[np.ndarray]:
    return [np.unpackbits(t, count=TABLE).view(bool) for t in tables]


def fit(texts: list[str], langs: list[str], per_lang: int = LANDMARKS_PER_LANG, most: int = LANDMARKS) -> Model:
    """:func:`fit_tables` of texts; those without letters are left out."""
    kept = [(np.packbits(t), lang) for text, lang in zip(texts, langs) if (t := presence(text)) is not None]
    return fit_tables([t for t, _ in kept], [lang for _, lang in kept], per_lang, most)


def fit_tables(
    tables: list[np.ndarray], langs: list[str], per_lang: int = LANDMARKS_PER_LANG, most: int = LANDMARKS
) -> Model:
    """Nyström kernel ridge regression; the first rows of each language are landmarks.

    Presence tables come packed to bits and are opened ``BATCH`` at a time. Every
    language is learned: if there are many, each has fewer landmarks.
    """
    names = sorted(set(langs))
    empty = np.zeros((0, 0), dtype=np.float32)
    if not names:
        return Model([], np.zeros(0, dtype=np.int64), empty, empty)
    of: dict[str, list[np.ndarray]] = {name: [] for name in names}
    for table, lang in zip(tables, langs):
        of[lang].append(table)
    number = min(per_lang, max(1, most // len(names)))
    while True:
        marks = [t for name in names for t in of[name][:number]]
        columns = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(marks), count=TABLE))
        if number == 1 or len(marks) * len(columns) * 4 <= LANDMARK_BYTES:
            break
        number //= 2
    model = Model(names, columns, empty, empty)
    model.landmarks = np.concatenate([
        model.rows(unpacked(marks[at:at + BATCH])) for at in range(0, len(marks), BATCH)
    ])
    among = np.concatenate([
        model.kernel(unpacked(marks[at:at + BATCH])) for at in range(0, len(marks), BATCH)
    ]).astype(np.float64)
    target = np.full((len(langs), len(names)), -1.0)
    target[np.arange(len(langs)), np.searchsorted(names, langs)] = 1.0
    left, right = np.zeros_like(among), np.zeros((len(marks), len(names)))
    for at in range(0, len(tables), BATCH):
        part = model.kernel(unpacked(tables[at:at + BATCH])).astype(np.float64)
        left += part.T @ part
        right += part.T @ target[at:at + BATCH]
    left += RIDGE * among + 1e-6 * np.eye(len(marks))
    model.weights = np.linalg.solve(left, right).astype(np.float32)
    return model


def held_out(id_col: str) -> Column:
    """Rows that nothing is learned from: the crc32 of the id's text leaves 2 by 4."""
    return F.coalesce(
        F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False)
    )


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = TRAIN_PER_LANG,
    most: int = TRAIN_ROWS,
) -> Model:
    """Fit on at most ``per_lang`` rows of every language, fewer if that makes more than ``most``.

    Rows that are not held out and have a language and a text with a letter
    count, in the order of a hash of their id and text; repeated rows are rows
    of their own. What comes to the driver of a text, however long, is its
    presence table of 21 KB, so the sample is bounded by rows and languages.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.where(
        ~held_out(id_col) & F.col(f"`{lang_col}`").isNotNull() & text.rlike(r"\p{L}")
    ).select(F.col(f"`{lang_col}`").alias("lang"), text.alias("text"),
             F.xxhash64(F.col(f"`{id_col}`"), F.lit("sample")).alias("at"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    counts = cut(counts)
    n_langs = counts.count()
    wanted = min(per_lang, max(2, most // max(1, n_langs)))
    # of each language a share that holds about twice as many as are wanted
    share = F.least(F.lit(1.0), F.lit(2.0 * wanted + 50) / F.col("n"))
    order = F.xxhash64("at", "text").alias("then")
    first = Window.partitionBy("lang").orderBy("at", "then")
    sample = (
        rows.join(counts, "lang")
        .where(F.pmod("at", F.lit(1_000_000)) < share * 1_000_000)
        .select("lang", "text", "at", order)
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= wanted)
    )

    def packed(texts: list[str]) -> dict[str, list]:
        found = [presence(t) for t in texts]
        return {"table": [None if t is None else np.packbits(t).tobytes() for t in found]}

    tables = with_text_columns(sample, "text", packed, {"table": T.BinaryType()}, ["lang", "place"])
    held = sorted(tables.where("table is not null").collect(), key=lambda r: (r["lang"], r["place"]))
    return fit_tables([np.frombuffer(r["table"], np.uint8) for r in held], [r["lang"] for r in held])


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs``: ``keep, lang_pred, score``.

    Only the text is looked at. A text that is null or has no letter is
    ``und`` with score 0, as are all texts if the model learned no language.
    ``score`` is the regression's value of the chosen language on 0 to 1; of
    equal values the first language in the order of names is chosen. A text is
    scored whole, however long, in parts of ``PART_CHARS``; repeated rows are scored
    each; an empty table gives no rows.
    ``keep`` are the columns passed on (all by default, but for the new names).
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]) -> dict[str, list]:
        langs, scores = sent.value.predict(texts)
        return {"lang_pred": langs, "score": scores}

    types = {"lang_pred": T.StringType(), "score": T.DoubleType()}
    return with_text_columns(docs, text_col, run, types, keep)
