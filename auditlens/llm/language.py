"""Language identification by multilingual mixtures.

Each language is a distribution over hashed letter trigrams. The languages of a document are the
mixture that explains its trigrams best: expectation-maximisation estimates the shares, and the set
of languages is the one with the best likelihood less a penalty for each language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import blocks

# Trigrams are counted in this many slots. The model has a number per language and slot, and
# languages are limited, so what goes to the executors is bounded: 64 kB a language.
SLOTS = 1 << 14
MAX_LANGUAGES = 512
SMOOTHING = 0.5
ROUNDS = 8
DOCUMENTS_AT_ONCE = 32

UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points are letters. Planes above the third hold no letters of a living script."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x30000)]))
    return _letters[0]


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each trigram and the number of its text. Letters are lower-cased, other runs are one gap."""
    letters = _letter_table()
    padded = ["" if t is None else f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), dtype=np.uint32)
    document = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    is_letter = letters[np.minimum(codes, len(letters) - 1)]
    codes = np.where(is_letter, codes, 0)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = is_letter[1:] | is_letter[:-1] | (document[1:] != document[:-1])
    codes, document = codes[keep].astype(np.uint32), document[keep]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    mixed = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    slots = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(18)
    within = (document[:-2] == document[2:]) & ((a != 0) | (b != 0)) & ((b != 0) | (c != 0))
    return slots[within].astype(np.int64), document[:-2][within]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of a task by language and slot."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for block in blocks(batch):
            slots, document = _trigrams(block.column("text").to_pylist())
            names = block.column("lang").to_pylist()
            order = {name: i for i, name in enumerate(dict.fromkeys(names))}
            of = np.array([order[name] for name in names])
            found = np.bincount(of[document] * SLOTS + slots, minlength=len(order) * SLOTS)
            for name, i in order.items():
                part = found[i * SLOTS : (i + 1) * SLOTS]
                counts[name] = counts[name] + part if name in counts else part
    for name, part in counts.items():
        seen = np.flatnonzero(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * len(seen), pa.string()),
                pa.array(seen.astype(np.int32)),
                pa.array(part[seen]),
            ],
            names=["lang", "slot", "n"],
        )


@dataclass(frozen=True)
class LanguageModel:
    """Names of the learned languages, in code point order, and their slot probabilities."""

    languages: tuple[str, ...]
    probabilities: np.ndarray  # slots x languages


def train(labelled: DataFrame) -> LanguageModel:
    """Learn from all rows (text, lang); rows without a text or language teach nothing."""
    labelled = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = (
        labelled.mapInArrow(_count, "lang string, slot int, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
    )
    found = counts.select("lang").distinct().limit(MAX_LANGUAGES + 1)
    counts = counts.persist()
    try:
        languages = sorted(r.lang for r in found.collect())
        if len(languages) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages: raise MAX_LANGUAGES")
        table = np.full((SLOTS, len(languages)), SMOOTHING)
        rows = counts.toPandas()
    finally:
        counts.unpersist()
    column = {name: i for i, name in enumerate(languages)}
    table[rows["slot"].to_numpy(int), rows["lang"].map(column).to_numpy(int)] += rows["n"].to_numpy()
    return LanguageModel(tuple(languages), (table / table.sum(axis=0)).astype(np.float32))


def _by_document(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _mixtures(
    p: np.ndarray, n: np.ndarray, starts: np.ndarray, document: np.ndarray
) -> np.ndarray:
    """Shares of the languages in each document, chosen by penalised likelihood.

    p: likelihoods of the trigrams (entries x languages), n: how often each stands in its document.
    Starts with all languages; each step fits the shares and then drops the language with the
    smallest share, and all that explain less than one trigram. The best step wins.
    """
    documents, languages = len(starts), p.shape[1]
    total = _by_document(n, starts)
    shares = np.full((documents, languages), 1.0 / languages)
    best = np.full(documents, -np.inf)
    chosen = shares.copy()
    active = np.ones(documents, dtype=bool)
    while active.any():
        for _ in range(ROUNDS):
            weight = p * shares[document]
            weight *= (n / weight.sum(axis=1))[:, None]
            shares = _by_document(weight, starts) / total[:, None]
        fit = _by_document(n * np.log((p * shares[document]).sum(axis=1)), starts)
        size = (shares > 0).sum(axis=1)
        score = fit - 0.5 * (size - 1) * np.log(total + 1) - 2.0 * (size - 1)
        better = active & (score > best)
        best[better], chosen[better] = score[better], shares[better]
        active &= size > 1
        least = np.where(shares > 0, shares, np.inf).argmin(axis=1)
        kept = shares.copy()
        kept[np.arange(documents), least] = 0
        kept[kept * total[:, None] < 1] = 0
        none = kept.sum(axis=1) == 0
        kept[none, shares[none].argmax(axis=1)] = 1
        kept /= kept.sum(axis=1, keepdims=True)
        shares = np.where(active[:, None], kept, shares)
    return chosen


def predict(docs: DataFrame, model: LanguageModel, keep: Sequence[str]) -> DataFrame:
    """Language of each text: the learned one with the largest share, that share, and all shares.

    Returns the columns `keep` of `docs` with lang_pred, score and languages (array of name and
    share, largest first). A text that is NULL or has no letter is `und` with score 0 and no
    languages, and so is all if nothing was learned. Of languages with equal shares the first in code
    point order is named. Texts of any length are read whole. Rows are neither dropped nor merged.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.probabilities))
    fields = [docs.schema[c] for c in keep]
    shares = T.ArrayType(T.StructType().add("lang", "string").add("share", "double"))
    schema = T.StructType(fields).add("lang_pred", "string").add("score", "double")
    schema = schema.add("languages", shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        share_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            for block in blocks(batch):
                texts = block.column("text").to_pylist()
                found = [
                    answer
                    for i in range(0, len(texts), DOCUMENTS_AT_ONCE)
                    for answer in _identify(texts[i : i + DOCUMENTS_AT_ONCE], names, table)
                ]
                pred, score, all_shares = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(c) for c in keep),
                        pa.array(pred, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(all_shares, share_type),
                    ],
                    names=[*keep, "lang_pred", "score", "languages"],
                )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _identify(
    texts: list[str | None], names: tuple[str, ...], table: np.ndarray
) -> list[tuple[str, float, list[tuple[str, float]]]]:
    out: list[tuple[str, float, list[tuple[str, float]]]] = [(UNKNOWN, 0.0, [])] * len(texts)
    if not names:
        return out
    readable = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
    slots, document = _trigrams([texts[i] for i in readable])
    counts = np.bincount(document * SLOTS + slots, minlength=len(readable) * SLOTS)
    entries = np.flatnonzero(counts)
    of, n = entries // SLOTS, counts[entries].astype(np.float64)
    present, starts = np.unique(of, return_index=True)
    shares = np.full((len(readable), len(names)), 1.0 / len(names))
    if len(present):
        document = np.repeat(np.arange(len(present)), np.diff(np.append(starts, len(of))))
        shares[present] = _mixtures(table[entries % SLOTS].astype(np.float64), n, starts, document)
    for i, share in zip(readable, shares):
        order = [int(j) for j in np.argsort(-share, kind="stable") if share[j] > 0]
        out[i] = (names[order[0]], float(min(1.0, share[order[0]])), [(names[j], float(share[j])) for j in order])
    return out


def held_out_languages(documents: DataFrame) -> DataFrame:
    """Train on four fifths of the documents and predict all.

    The fifth whose crc32 of doc_id is divisible by 5 is held out; rows without a doc_id are neither
    learned from nor held out. Only text and lang are learned from, only text is predicted from.
    """
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = train(documents.filter(part != 0).select("text", "lang"))
    docs = documents.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "text")
    return predict(docs, model, ["doc_id", "held_out"])
