"""Personal data: patterns propose, checksums confirm, words nearby adjust the score."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retourlens.llm.tables import free_name, whole_text

#: Kinds in the order that breaks ties; the first four follow the fixed definitions.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "phone_local")
#: Characters on either side of a span in which context words count.
CONTEXT_CHARS = 48
#: Score at which a span that no fixed definition covers is reported.
LEAST_SCORE = 0.5
BATCH_BYTES = 8 << 20

# Score of a bare pattern, of a passed checksum, and of one context word nearby.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "phone_local": 0.2}
CHECKSUM_SCORE, CONTEXT_SCORE, AGAINST_SCORE = 0.5, 0.35, -0.3
# Words that speak for a kind, and words that speak against any.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "example", "sku")
# Characters of an account number by country, as in the IBAN registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}

# The patterns. Runs are possessive and start where a run starts, which finds the same
# leftmost matches in linear time; an address is sought from its @ and extended to the left.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    free = 0
    for found in AT_DOMAIN.finditer(text) if "@" in text else ():
        start = at = found.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            free = found.end()
            yield start, free, True


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split(".")):
            yield *found.span(), True


def _cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in DIGITS.finditer(text):
        if found.end() - found.start() < 14:
            continue
        digits = found[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield *found.span(), True


def _phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in found[0]) <= 15:
            yield *found.span(), False


def _ibans(text: str) -> Iterator[tuple[int, int, bool]]:
    free = 0
    # Every start is tried, as what follows an account or a failed start may be one too.
    for begun in IBAN_START.finditer(text):
        start, length = begun.start(), IBAN_LENGTHS.get(begun[0][:2])
        found = IBAN.match(text, start) if length and start >= free else None
        if not found:
            continue
        places = [i for i in range(start, found.end()) if text[i] != " "]
        if len(places) < length:
            continue
        end = places[length - 1] + 1
        if (end == len(text) or not text[end].isalnum()) and mod97(text[start:end].replace(" ", "")):
            free = end
            yield start, end, True


def _plain(pattern: re.Pattern):
    return lambda text: ((*found.span(), False) for found in pattern.finditer(text))


PROPOSE = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _plain(SSN),
    "phone_local": _plain(LOCAL_PHONE),
}


def _score(kind: str, text: str, start: int, end: int, checked: bool) -> float:
    score = BASE_SCORE[kind] + CHECKSUM_SCORE * (checked and kind in ("card", "iban"))
    around = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()
    words = set(WORD.findall(around))
    score += CONTEXT_SCORE * any(w in words for w in CONTEXT[kind])
    score += AGAINST_SCORE * any(w in words for w in AGAINST)
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str, least: float = LEAST_SCORE) -> list[Span]:
    """Spans of a text by start, then kind. Those of the first four kinds always
    stay, whatever their score; others need ``least``, and those that no checksum
    confirms may not overlap them. A confirmed account stays beside a card that
    its digits make by chance."""
    base = [
        Span(kind, start, end, _score(kind, text, start, end, checked))
        for kind in BASE_KINDS for start, end, checked in PROPOSE[kind](text)
    ]
    # Bounds of the stretches that spans cover, merged, for the overlap test.
    covered: list[list[int]] = []
    for start, end in sorted((s.start, s.end) for s in base):
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    starts, more = [c[0] for c in covered], []
    for kind in KINDS[len(BASE_KINDS) :]:
        for start, end, checked in PROPOSE[kind](text):
            at = bisect_right(starts, end - 1) - 1
            score = _score(kind, text, start, end, checked)
            if score >= least and (checked or at < 0 or covered[at][1] <= start):
                more.append(Span(kind, start, end, score))
    return sorted([*base, *more], key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
    ])
)
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def detect(
    docs: DataFrame, text: str = "text", output: str = "spans", carry: list[str] | None = None, least: float = LEAST_SCORE
) -> DataFrame:
    """``carry`` (all columns unless given) and an array of (kind, start, end, score).

    Offsets count code points, ends are exclusive. Null and empty texts have an
    empty array; a column named as the output is replaced. Each row is looked
    at by itself, so repeated rows give equal results.
    """
    carry = [c for c in (carry or docs.columns) if c.lower() != output.lower()]
    value = free_name(docs, "value")
    rows = docs.select(*carry, whole_text(text).alias(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, found = 0, 0, []
            for i, item in enumerate(batch.column(value)):
                whole = item.as_py()
                found.append([vars(s) for s in find_spans(whole, least)])
                held += len(whole)
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    columns = [*[part.column(c) for c in carry], pa.array(found, _ARROW_SPANS)]
                    yield pa.RecordBatch.from_arrays(columns, [*carry, output])
                    start, held, found = i + 1, 0, []

    schema = T.StructType([*[rows.schema[c] for c in carry], T.StructField(output, SPANS)])
    return rows.mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets.

    Spans that overlap are replaced together, by the kind of the one that starts
    first; a null text stays null.
    """
    step = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    body = F.col(text)

    def put(state, span):
        between = F.substring(body, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        replaced = F.struct(
            F.concat(state["done"], between, F.lit("["), span["kind"], F.lit("]")).alias("done"), span["end"].alias("at")
        )
        longer = F.struct(state["done"].alias("done"), F.greatest(state["at"], span["end"]).alias("at"))
        return F.when(span["start"] >= state["at"], replaced).otherwise(longer)

    rest = lambda s: F.concat(s["done"], F.substring(body, (s["at"] + 1).cast("int"), F.lit(1 << 30)))
    return docs.withColumn(text, F.aggregate(spans, step, put, rest))
