"""Language identification by bit-sliced Bloom filters over character n-grams.

The filters of all languages share one table: each row is a hash position and
each bit of it a language.  And-ing the rows of an n-gram returns, at once, the
bitmask of all languages whose filter holds it.  A text's n-grams are looked up
in bulk; each language's bit is counted over them, and what its filter's fill
lets through by chance is taken off.  The language with most n-grams left is
the answer.

An n-gram belongs to a language where it stands in ``SUPPORT`` texts of it and in
a share of its texts that is ``CONTRAST`` or more of the largest share in any
language, so neither quotations nor a growing corpus fill the filters.  N-grams
are runs of one to ``LONGEST`` letters of the lower-cased text in Unicode form C;
the longer ones may begin or end with a word's border.

Texts learned from are a bounded sample: about ``SAMPLE`` different texts of each
language, chosen by a hash of the text.  Every row is scored by its whole text.
``POSITIONS`` rows of eight bytes for each 64 languages bound the model.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0.
Rows without a language, or without a letter, teach nothing, and a text repeated
within a language teaches once; a NULL doc_id is the text '' for the fold.  A
text none of whose n-grams is known gets the language with most texts, with
score 0, and every text is ``und`` while no language is known.  Ties go to the
language with more texts, then to the smaller name.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus.llm.common import stored

FOLDS = 4
HELD_OUT_FOLD = 2
UNKNOWN = "und"
LONGEST = 5
#: Different texts of each language that are learned from, about.
SAMPLE = 4_000
SUPPORT = 2
CONTRAST = 0.2
#: Rows of the table (a power of two) and rows looked up for an n-gram.
POSITIONS = 1 << 20
LOOKUPS = 3
#: Characters hashed at a time.
WINDOW = 1 << 15
_SLICE = 64


@dataclass(frozen=True)
class Model:
    #: By falling number of texts.
    languages: tuple[str, ...]
    #: (slices of 64 languages, POSITIONS): the filters.
    table: np.ndarray
    #: Chance that a language's filter holds an n-gram it was not given.
    by_chance: np.ndarray


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT_FOLD


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 2 for a letter, 1 for a mark, 0 for others."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], dtype=np.uint8)


def codes(text: str | None) -> np.ndarray:
    """Letters and marks as code points, with one 0 before, between and after words; empty without a letter."""
    text = unicodedata.normalize("NFC", (text or "").lower())
    found = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kinds = _kinds()[found]
    if not (kinds == 2).any():
        return np.zeros(0, np.uint32)
    padded = np.zeros(len(found) + 2, np.uint32)
    padded[1:-1] = np.where(kinds > 0, found, 0)
    kept = np.ones(len(padded), bool)
    kept[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    return padded[kept]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(code: np.ndarray, start: int, stop: int):
    """For each order: (hashes, starts) of the n-grams that start in [start, stop) and span no border."""
    part = code[start : stop + LONGEST - 1].astype(np.uint64)
    letter = part != 0
    rolled = part.copy()
    whole = letter.copy()
    for order in range(1, LONGEST + 1):
        count = min(stop - start, len(part) - order + 1)
        if count <= 0:
            return
        if order > 1:
            rolled = rolled[:count] * np.uint64(0x100000001B3) + part[order - 1 : order - 1 + count]
            if order == 2:
                whole = letter[:count] | letter[1 : 1 + count]
            else:
                # The characters between the first and the last one are letters.
                inside = letter[1 : 1 + count] if order == 3 else inside[:count] & letter[order - 2 : order - 2 + count]
                whole = inside
        at = np.flatnonzero(whole[:count])
        yield _mixed(rolled[at] ^ (np.uint64(order) << np.uint64(56))), at + start


def rows_of(gram: np.ndarray):
    """The table rows of each n-gram, one array for each lookup."""
    low, high = gram & np.uint64(0xFFFFFFFF), gram >> np.uint64(32)
    for j in range(LOOKUPS):
        yield (low + np.uint64(j) * high) & np.uint64(POSITIONS - 1)


def _row_columns(gram: Column) -> Column:
    """The same rows as an array column."""
    low, high = gram.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(gram, 32)
    return F.array(*[(low + F.lit(j) * high).bitwiseAND(F.lit(POSITIONS - 1)) for j in range(LOOKUPS)])


def _gram_counts(sample: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """(gram, language, texts): the number of sample texts of a language that hold an n-gram, in parts."""
    index = {name: i for i, name in enumerate(languages)}

    def count(batches):
        for batch in batches:
            held = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                code = codes(text.as_py())
                found = [h for s in range(0, len(code), WINDOW) for h, _ in grams(code, s, min(s + WINDOW, len(code)))]
                if found:
                    held.setdefault(index[lang], []).append(np.unique(np.concatenate(found)))
            for language, texts in held.items():
                gram, n = np.unique(np.concatenate(texts), return_counts=True)
                for start in range(0, len(gram), WINDOW):
                    part = slice(start, start + WINDOW)
                    yield pa.RecordBatch.from_pydict({
                        "gram": pa.array(gram[part].view(np.int64)),
                        "language": pa.array(np.full(len(gram[part]), language, np.int32)),
                        "texts": pa.array(n[part].astype(np.int64)),
                    })

    parts = sample.mapInArrow(count, "gram bigint, language int, texts bigint")
    return parts.groupBy("gram", "language").agg(F.sum("texts").alias("texts"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn the languages of the rows outside the held-out fold."""
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h")
    )
    sizes = known.select("lang", "h").distinct().groupBy("lang").count().collect()
    sizes = {r["lang"]: r["count"] for r in sorted(sizes, key=lambda r: (-r["count"], r["lang"]))}
    languages = tuple(sizes)
    slices = -(-len(languages) // _SLICE)
    table = np.zeros((slices, POSITIONS), np.uint64)
    if not languages:
        return Model((), table, np.zeros(0))
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, sample / n))])
    chosen = known.where(F.col("h") / 2.0**64 + 0.5 <= share[F.col("lang")])
    chosen = stored(chosen.dropDuplicates(["lang", "h"]).select("lang", "text"), "language-sample")
    learned = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    texts = F.array(*[F.lit(float(max(1, learned.get(name, 0)))) for name in languages])
    rate = F.col("texts") / F.get(texts, F.col("language"))
    spread = (
        _gram_counts(chosen, languages)
        .where(F.col("texts") >= SUPPORT)
        .groupBy("gram")
        .agg(F.collect_list(F.struct("language", rate.alias("rate"))).alias("held"))
    )
    most = F.array_max(F.transform("held", lambda x: x["rate"]))
    members = spread.select(
        F.explode(_row_columns(F.col("gram"))).alias("position"),
        F.filter("held", lambda x: x["rate"] >= CONTRAST * most)["language"].alias("languages"),
    ).select("position", F.explode("languages").alias("language"))
    bit = F.expr(f"shiftleft(1L, language % {_SLICE})")
    filled = members.groupBy("position", (F.col("language") / _SLICE).cast("int").alias("slice")).agg(F.bit_or(bit).alias("bits"))
    # POSITIONS rows for each 64 languages at most.
    found = filled.toArrow()
    table[found["slice"].to_numpy(), found["position"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    fill = np.array([
        np.count_nonzero(table[i // _SLICE] & np.uint64(1 << i % _SLICE)) / POSITIONS for i in range(len(languages))
    ])
    return Model(languages, table, fill**LOOKUPS)


def masks(model: Model, gram: np.ndarray) -> list[np.ndarray]:
    """For each slice, the bitmask of all languages whose filter holds each n-gram."""
    rows = list(rows_of(gram))
    out = []
    for table in model.table:
        mask = table[rows[0]]
        for r in rows[1:]:
            mask &= table[r]
        out.append(mask)
    return out


def counts(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of each text, of these those each language's filter holds)."""
    total = np.zeros(len(texts), np.int64)
    hits = np.zeros((len(texts), len(model.languages)), np.int64)
    parts, owners, held = [], [], 0

    def tally():
        # Neighbours share no border character, so no n-gram spans two texts.
        code, owner = np.concatenate(parts), np.repeat(owners, [len(p) for p in parts])
        for start in range(0, len(code), WINDOW):
            for gram, at in grams(code, start, min(start + WINDOW, len(code))):
                of = owner[at]
                total[:] += np.bincount(of, minlength=len(texts))
                for s, mask in enumerate(masks(model, gram)):
                    for bit in range(min(_SLICE, len(model.languages) - s * _SLICE)):
                        has = (mask >> np.uint64(bit)) & np.uint64(1)
                        hits[:, s * _SLICE + bit] += np.bincount(of[has.astype(bool)], minlength=len(texts))

    for i, text in enumerate(texts):
        code = codes(text)
        if not len(code):
            continue
        # The border before a text serves as the one after its predecessor.
        parts.append(code[:-1])
        owners.append(i)
        held += len(code)
        if held >= WINDOW:
            parts.append(np.zeros(1, np.uint32))
            owners.append(i)
            tally()
            parts, owners, held = [], [], 0
    if parts:
        parts.append(np.zeros(1, np.uint32))
        owners.append(owners[-1])
        tally()
    return total, hits


def decide(model: Model, total: np.ndarray, hits: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Each text's language, and how far it leads: its count over that of the first two."""
    if not model.languages:
        return [UNKNOWN] * len(total), np.zeros(len(total))
    # A full filter says nothing.
    free = np.where(model.by_chance < 1, 1 - model.by_chance, np.inf)
    real = np.maximum(0.0, (hits - total[:, None] * model.by_chance) / free)
    first = real.argmax(axis=1)
    ranked = np.sort(real, axis=1)[:, ::-1]
    rest = ranked[:, 1] if ranked.shape[1] > 1 else np.zeros(len(total))
    score = ranked[:, 0] / np.maximum(ranked[:, 0] + rest, 1e-300)
    return [model.languages[i] if n else UNKNOWN for i, n in zip(first, total)], np.where(total > 0, score, 0.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, by its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            total, hits = counts(shared.value, batch.column("text").to_pylist())
            names, score = decide(shared.value, total, hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
