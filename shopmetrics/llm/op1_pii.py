"""Personal data: regular expressions propose spans, checksums confirm, context scores.

Each kind has a pattern, a validator (Luhn for cards, mod-97 for IBANs, digit and range
checks for the rest) and context words.  A valid span starts from its kind's score and
gains when a context word stands in the 48 code points before it.  email, ip, card and
phone are always reported; IBANs are confirmed by their checksum; dashed nine-digit
numbers have no checksum and count only with context.

Only DataFrame functions are used.  Defined cases: a null or empty text has no spans; a
null id or repeated row gives its own result row; every other column of the input is
ignored.  Cost is linear in the text; positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

CONTEXT_CHARS = 48
CONTEXT_GAIN = 0.3
THRESHOLD = 0.5
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
VALID_IP = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the digit string passes the Luhn checksum."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(chars, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True if the compact account number leaves remainder 1 (ISO 13616)."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")

    def step(r: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, (r * 10 + code - 48) % 97).otherwise((r * 100 + code - 55) % 97)

    return F.aggregate(chars, F.lit(0), step) == 1


def _valid(kind: str, hit: Column) -> Column:
    size = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(VALID_IP)
    if kind == "card":
        return size.between(12, 19) & luhn(_digits(hit))
    if kind == "phone":
        return size.between(9, 15)
    if kind == "iban":
        compact = F.regexp_replace(hit, " ", "")
        return F.length(compact).between(15, 34) & mod97(compact)
    return F.lit(True)


#: kind: (pattern, cheap test that a text can hold it, score, context words).  The guards
#: (\\G or a lookbehind) and possessive loops keep the hits of the plain pattern and make
#: long runs of one class linear.
KINDS: dict[str, tuple[str, str, float, str]] = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|server|host|address"),
    "card": (r"[0-9](?:[ -]?[0-9]){11,}+", "", 0.8, "card|visa|credit|tarjeta|carte|karte"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.6, "phone|call|tel|mobile|fax"),
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+", "", 0.9, "iban|account|konto|compte|cuenta"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", 0.3, "ssn|social security|tax id|seguridad social"),
}
BASE = ["email", "ip", "card", "phone"]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): spans sorted by start, each with kind, end, hit, context and score."""
    d = docs.select(F.col(id_col).alias("doc_id"), C.whole_text(text_col).alias("text"))
    none = F.array().cast("array<string>")
    hits = d.select("*", *[
        F.when(F.col("text").contains(hint), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}")
        if hint else F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}")
        for k, (p, hint, _, _) in KINDS.items()])

    def scored(order: int, kind: str) -> Column:
        pattern, _, score, context = KINDS[kind]
        found = C.match_spans(F.col(f"m_{kind}"), F.col("text"), pattern, kind, order)
        valid = F.filter(found, lambda s: _valid(kind, s["hit"]))

        def rate(s: Column) -> Column:
            ahead = F.least(s["start"], F.lit(CONTEXT_CHARS))
            before = F.lower(F.substring(F.col("text"), s["start"] - ahead + 1, ahead))
            near = before.rlike(context)
            return s.withField("context", near).withField(
                "score", F.lit(score) + F.when(near, F.least(F.lit(CONTEXT_GAIN), F.lit(1 - score))).otherwise(0.0))

        rated = F.transform(valid, rate)
        return rated if kind in BASE else F.filter(rated, lambda s: s["score"] >= THRESHOLD)

    spans = F.sort_array(F.concat(*[scored(i, k) for i, k in enumerate(KINDS)]))
    return hits.select("doc_id", spans.alias("spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(C.table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return found.select(
        "doc_id", *[C.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(C.joined(base), 256).alias("base_sha256"), C.joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["context"])).cast("long").alias("n_context"))


def _oracle() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sql = (f"list_sum(list_transform(range(0, length({digits})), lambda j: CASE WHEN j % 2 = 0 THEN CAST(reverse({digits})[j + 1] AS INT)"
                f" WHEN CAST(reverse({digits})[j + 1] AS INT) > 4 THEN 2 * CAST(reverse({digits})[j + 1] AS INT) - 9"
                f" ELSE 2 * CAST(reverse({digits})[j + 1] AS INT) END)) % 10 = 0")
    compact = "replace(m, ' ', '')"
    turned = f"(substr({compact}, 5) || substr({compact}, 1, 4))"
    mod_sql = (f"list_reduce(list_prepend(0, list_transform(string_split({turned}, ''), lambda c: ascii(c))),"
               " lambda r, c: CASE WHEN c <= 57 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END) = 1")
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", f"regexp_matches(m, '{VALID_IP}')"),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({digits}) BETWEEN 12 AND 19 AND {luhn_sql}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15"),
        ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", f"length({compact}) BETWEEN 15 AND 34 AND {mod_sql}"),
        ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "true"),
    ]
    near = "CASE kind " + " ".join(f"WHEN '{k}' THEN regexp_matches(before, '{v[3]}')" for k, v in KINDS.items()) + " END"
    return C.span_oracle(kinds, BASE, f",\n  count(*) FILTER (WHERE {near}) AS n_context",
                         {"ssn": f"regexp_matches(before, '{KINDS['ssn'][3]}')"})


ORACLE = _oracle()
