"""Quality rules: counts of words, symbols and repeats, and how well a public vocabulary fits the text.

Prose that a tokeniser knows is cut into few, varied tokens. Three measures over the words of a text say
how far it is from that: characters per token, the share of tokens that are single bytes because the
vocabulary lacks the character, and the entropy of the tokens (in bits, as a share of the entropy that
as many different tokens would have). Each language, or the script of the text where the language is not
known, has bands outside which a text is rejected.

Byte-pair merges do not cross words, so every distinct word is cut once for each worker and remembered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tables import parts, pick

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: A vocabulary file is broadcast; larger ones are refused.
VOCABULARY_LIMIT = 64 << 20
#: Words remembered by a worker at most; beyond it they are forgotten all at once and cut again.
REMEMBERED = 400_000
#: Texts of fewer tokens are too short to measure.
MIN_TOKENS = 40
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

# Bands by language or, where that is not listed, by script:
# characters per token (least, most), byte share (most), relative entropy (least).
BANDS = {
    "en": (1.35, 8.0, 0.2, 0.25),
    "de": (1.35, 8.0, 0.2, 0.25),
    "fr": (1.25, 8.0, 0.2, 0.25),
    "es": (1.25, 8.0, 0.2, 0.25),
    "latin": (1.2, 9.0, 0.3, 0.25),
    "cyrillic": (1.0, 8.0, 0.3, 0.25),
    "greek": (0.7, 8.0, 0.5, 0.25),
    "other": (0.25, 8.0, 0.95, 0.2),
}

COLUMNS = (
    "key, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
    "chars_per_token double, byte_share double, entropy double, band string, base_failed boolean, kept boolean"
)


def script(text: str) -> str:
    """The script most letters of a text are in; each is known by its block of code points."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    blocks = {
        "latin": (points >= 0x41) & (points <= 0x7A) | (points >= 0xC0) & (points <= 0x24F),
        "greek": (points >= 0x370) & (points <= 0x3FF),
        "cyrillic": (points >= 0x400) & (points <= 0x52F),
        "other": points >= 0x530,
    }
    counts = {name: int(hit.sum()) for name, hit in blocks.items()}
    return max(counts, key=counts.get)


def band_of(lang: str | None, text: str) -> str:
    known = (lang or "").lower()[:2]
    return known if known in BANDS else script(text)


def duplicate_lines(text: str, words_in=bytes.split) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if words_in(line.encode())]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that are found twice or more in the text, the first one included."""
    windows = list(zip(*(words[i:] for i in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows)))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


class Cutter:
    """Token ids of words, remembered."""

    def __init__(self, model: bytes) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.known: dict[bytes, np.ndarray] = {}

    def histogram(self, words: Counter) -> np.ndarray:
        """How often each token occurs in a text with these words."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        for word, ids in zip(new, self.pieces.encode([w.decode() for w in new], num_threads=1)):
            self.known[word] = np.array(ids, dtype=np.int32)
        if not words:
            return np.zeros(0, dtype=np.int64)
        cut = [self.known[w] for w in words]
        times = np.repeat(np.fromiter(words.values(), dtype=np.int64, count=len(cut)), [len(c) for c in cut])
        return np.bincount(np.concatenate(cut), weights=times, minlength=len(self.is_byte)).astype(np.int64)


def judge(text: str | None, lang: str | None, cutter: Cutter) -> tuple:
    """The columns after the key, for one whole text; a null text has no words."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    counts = Counter(words)
    n, chars = len(words), sum(len(w.decode()) * k for w, k in counts.items())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeated = repeated_words(words)
    tokens = cutter.histogram(counts)
    total = int(tokens.sum())
    share = tokens[tokens > 0] / max(total, 1)
    entropy = float(-(share * np.log2(share)).sum()) + 0.0
    per_token = chars / total if total else None
    bytes_ = float(tokens[cutter.is_byte].sum() / total) if total else None
    band = band_of(lang, text)
    failed = n < 10 or 100 * repeated > 20 * n
    least, most, most_bytes, least_entropy = BANDS[band]
    fits = total < MIN_TOKENS or (
        least <= per_token <= most and bytes_ <= most_bytes and entropy >= least_entropy * np.log2(total)
    )
    return (
        n, chars, symbols, duplicate_lines(text), repeated, total, per_token, bytes_, entropy, band, failed,
        bool(not failed and fits),
    )


@lru_cache(2)
def _cutter(model: bytes) -> Cutter:
    return Cutter(model)


def read_vocabulary(path: str, limit: int = VOCABULARY_LIMIT) -> bytes:
    """A vocabulary file of the driver, to be broadcast."""
    with open(path, "rb") as file:
        model = file.read(limit + 1)
    if len(model) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return model


def measure(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per document with the columns ``COLUMNS``.

    base_failed: fewer than 10 words, or over a fifth of them in repeated windows. kept: not failed, and within
    the band of its language or script (texts of fewer than MIN_TOKENS tokens are not measured against it).
    Null texts have no words and fail. Repeated rows stay repeated; an empty table gives no rows.
    """
    rows = pick(docs, key=key, text=text, lang=lang).withColumn("lang", F.col("lang").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = COLUMNS.replace("key", f"key {rows.schema['key'].dataType.simpleString()}", 1)
    names = [c.split()[0] for c in schema.split(", ")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(shared.value)
        for batch in parts(batches):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            found = list(zip(*(judge(x, known, cutter) for x, known in zip(texts, langs)))) or [()] * (len(names) - 1)
            types = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()] + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(list(v), type=t) for v, t in zip(found, types))], names
            )

    return rows.mapInArrow(judged, schema)
