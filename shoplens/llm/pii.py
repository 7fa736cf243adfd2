"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Kinds, in the order in which they are listed:

========  =====================================================  ===================
kind      proposed by                                            confirmed by
========  =====================================================  ===================
email     local part, @, dotted domain                           -
ip        four dotted numbers                                    parts up to 255
card      digits, single blanks or hyphens between them          16-19 digits, Luhn
phone     + and digits with blanks, dots, brackets, hyphens      8-15 digits
iban      two letters, two digits, groups of letters and digits  length, mod 97
ssn       3-2-4 digits with hyphens                              ranges in use
secret    a name such as password or token, "=" and a value      -
========  =====================================================  ===================

Matches are leftmost and do not overlap within a kind; a match that is not confirmed is dropped
and not tried again. The first four kinds are always reported, whatever their score; the others from
``THRESHOLD`` on. The score is the kind's own, raised where a word that goes with the kind is within
``REACH`` characters before the span or a few after it, and lowered near words for test data.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.tables import parts

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn", "secret"]
REACH, AFTER = 48, 16
THRESHOLD = 0.5

# Own score of each kind, words that raise it, words that lower any.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.35, "secret": 0.6}
RAISES = {
    "email": ["email", "e-mail", "mail", "contact", "write to"],
    "ip": ["ip", "address", "server", "host", "login"],
    "card": ["card", "credit", "visa", "mastercard", "payment", "carte", "karte", "tarjeta"],
    "phone": ["phone", "call", "tel", "mobile", "fax", "telefon", "appel"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social security", "security number"],
    "secret": ["login", "account", "credentials", "private"],
}
LOWERS = ["example", "sample", "dummy", "version", "isbn", "order number"]
RAISE, LOWER = 0.3, 0.2
# Lengths of IBANs by country.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SK": 24, "TR": 26,
}

SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)

# A run of digits fails as a whole if it fails at its start, so looking only there keeps long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"""\b(?:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}["']?([^\s"']{8,})""", re.IGNORECASE)
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: the local part is all that can be one before it, since it cannot hold an @."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if found:
            yield start, found.end()
            at = done = found.end()


def _matching(pattern: re.Pattern, confirmed: Callable[[str], bool], group: int = 0):
    def spans(text: str) -> Iterator[tuple[int, int]]:
        for m in pattern.finditer(text):
            if confirmed(m[group]):
                yield m.span(group)

    return spans


def _ssn_in_use(number: str) -> bool:
    area, group, serial = number.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _iban_holds(match: str) -> bool:
    plain = match.replace(" ", "")
    return IBAN_LENGTH.get(plain[:2]) == len(plain) and mod97(plain)


def _card_holds(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _ip_holds(match: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match.split("."))


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _matching(_IP, _ip_holds),
    "card": _matching(_CARD, _card_holds),
    "phone": _matching(_PHONE, lambda match: 8 <= len(_NOT_DIGIT.sub("", match)) <= 15),
    "iban": _matching(_IBAN, _iban_holds),
    "ssn": _matching(_SSN, _ssn_in_use),
    "secret": _matching(_SECRET, lambda value: any(c.isdigit() for c in value), 1),
}
_WORDS = {kind: re.compile(r"\b(?:" + "|".join(map(re.escape, words)) + r")\b") for kind, words in RAISES.items()}
_LOWERING = re.compile(r"\b(?:" + "|".join(map(re.escape, LOWERS)) + r")\b")


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of a whole text by kind, then start; code points, end exclusive."""
    found = []
    for kind in KINDS:
        for start, end in FINDERS[kind](text or ""):
            near = f"{text[max(0, start - REACH) : start]} {text[end : end + AFTER]}".lower()
            score = SCORE[kind] + RAISE * bool(_WORDS[kind].search(near)) - LOWER * bool(_LOWERING.search(near))
            score = round(min(1.0, max(0.0, score)), 2)
            if kind in BASE or score >= THRESHOLD:
                found.append((kind, start, end, score))
    return found


@F.pandas_udf(SPAN)
def spans(texts: pd.Series) -> pd.Series:
    """Column of the spans of whole texts. Null and empty texts have none."""
    return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in find(x)] for x in texts], dtype=object)


def listed(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas in their order."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind, as in [EMAIL]; what overlaps is replaced as one."""
    if text is None:
        return None
    done, out = 0, []
    for start, end, kind in sorted((start, -end, kind) for kind, start, end, _ in find(text)):
        if -end <= done:
            continue
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = -end
    return "".join([*out, text[done:]])


def mask_texts(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with masked texts, and with their new length where there is a column for it. All rows stay."""
    at = docs.columns.index(text)
    rows = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts = pa.array([mask(x) for x in batch.column(at).to_pylist()], type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    rows = rows.mapInArrow(replaced, rows.schema)
    if length in docs.columns:
        n = docs.columns.index(length)
        rows = rows.withColumn(f"_{n}", F.length(f"_{at}").cast(docs.schema[n].dataType))
    return rows.toDF(*docs.columns)
