"""PII masking and prompt-injection scoring as plain column expressions.

No Python worker is involved; the regexes run inside the JVM over whole texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# PII patterns and their replacements, applied in this order.
PII_RULES = [
    (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL_REDACTED]"),
    (r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", "[PHONE_REDACTED]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN_REDACTED]"),
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[IP_REDACTED]"),
]

# Injection patterns (case-insensitive) with weight and category.
INJECTION_RULES = [
    (r"ignore\s+(all\s+)?previous\s+instructions", 0.9, "ignore_instructions"),
    (r"ignore\s+(all\s+)?prior\s+instructions", 0.9, "ignore_instructions"),
    (r"you\s+are\s+now\s+", 0.7, "role_override"),
    (r"pretend\s+(you\s+are|to\s+be)\s+", 0.7, "role_override"),
    (r"act\s+as\s+if\s+you", 0.6, "role_override"),
    (r"system:\s*", 0.8, "system_prompt_leak"),
    (r"<\|im_start\|>system", 0.95, "delimiter_attack"),
    (r"<\|endoftext\|>", 0.85, "delimiter_attack"),
    (r"ADMIN\s+OVERRIDE", 0.9, "authority_claim"),
    (r"DAN\s+mode", 0.85, "jailbreak"),
    (r"do\s+anything\s+now", 0.8, "jailbreak"),
    (r"developer\s+mode", 0.75, "jailbreak"),
    (r"bypass\s+(safety|content)\s+filter", 0.9, "filter_bypass"),
    (r"base64\s+decode", 0.6, "encoding_bypass"),
    (r"\\x[0-9a-fA-F]{2}", 0.5, "encoding_bypass"),
]


# Words each match of the rule contains, whatever its case.
INJECTION_WORDS = [
    ["ignore", "previous", "instructions"],
    ["ignore", "prior", "instructions"],
    ["you", "are", "now"],
    ["pretend"],
    ["act", "as", "if", "you"],
    ["system:"],
    ["<|im_start|>system"],
    ["<|endoftext|>"],
    ["admin", "override"],
    ["dan", "mode"],
    ["do", "anything", "now"],
    ["developer", "mode"],
    ["bypass", "filter"],
    ["base64", "decode"],
    ["\\x"],
]

# The letters beyond ASCII that equal an ASCII letter when case is ignored.
CASE_TWINS = ["\u017f", "\u212a", "\u0130", "\u0131"]


def _unicode(pattern: str, flags: str = "U") -> str:
    r"""Java spelling of a pattern whose ``\s``, ``\d`` and ``\b`` are Unicode-aware.

    Without ``(?U)`` a non-breaking space between two words would hide them from
    the detector. The separators U+001C to U+001F count as ``\s`` as well.
    """
    return f"(?{flags})" + pattern.replace(r"\s", r"[\s\x1c-\x1f]")


# An address can only start where a run of its characters does, or right behind the
# one before it. Saying so keeps the search linear on long runs without an @.
ADDRESS_START = r"(?:\G|(?<![a-zA-Z0-9._%+-]))"


def mask_pii(text: Column) -> Column:
    """Replace e-mail addresses, phone numbers, SSNs and IPs, in that order.

    Texts without an @ hold no address, and the other rules need three digits in
    a row or a dot between two; one search for these spares most texts the rest.
    """
    has_digits = text.rlike(r"\p{Nd}(\p{Nd}{2}|\.\p{Nd})")
    (address, address_mark), *others = PII_RULES
    body = F.when(
        text.contains("@"), F.regexp_replace(text, ADDRESS_START + address, address_mark)
    ).otherwise(text)
    masked = body
    for pattern, mark in others:
        masked = F.regexp_replace(masked, _unicode(pattern), mark)
    return F.when(has_digits, masked).otherwise(body)


def apply_pii_masking(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """Mask the given columns; names that are absent are skipped, NULL stays NULL."""
    present = [c for c in text_columns if c in df.columns]
    return df.withColumns({c: mask_pii(F.col(c)) for c in present})


def free_text_columns(df: DataFrame) -> list[str]:
    """String columns whose name speaks of text or messages."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
        and any(word in f.name.lower() for word in ("text", "message"))
    ]


def injection_verdict(text: Column) -> Column:
    """Struct of ``score`` and ``pattern`` for the strongest rule.

    A rule scores weight x matches, at most 1. Of equal scores the rule listed
    first wins; without a match the verdict is 0.0 / "none". A rule's regex runs
    only where its words occur.
    """
    body = F.coalesce(text, F.lit(""))
    folded = F.lower(body)
    twins = reduce(lambda a, b: a | b, [body.contains(c) for c in CASE_TWINS])

    def hits(pattern: str, words: list[str]) -> Column:
        possible = twins | reduce(lambda a, b: a & b, [folded.contains(w) for w in words])
        found = F.regexp_count(body, F.lit(_unicode(pattern, "iU")))
        return F.when(possible, found).otherwise(F.lit(0))

    scored = [
        F.struct(
            F.least(hits(pattern, words) * F.lit(weight), F.lit(1.0)).alias("score"),
            F.lit(-place).alias("place"),
            F.lit(category).alias("pattern"),
        )
        for place, ((pattern, weight, category), words) in enumerate(
            zip(INJECTION_RULES, INJECTION_WORDS, strict=True)
        )
    ]
    nothing = F.struct(
        F.lit(0.0).alias("score"), F.lit(1).alias("place"), F.lit("none").alias("pattern")
    )
    return F.array_max(F.array(nothing, *scored))


def detect_injections(df: DataFrame, text_column: str, threshold: float = 0.5) -> DataFrame:
    """Add ``injection_risk_score``, ``injection_pattern`` and ``is_injection_attempt``."""
    return (
        df.withColumn("_verdict", injection_verdict(F.col(text_column)))
        .withColumns(
            {
                "injection_risk_score": F.col("_verdict.score"),
                "injection_pattern": F.col("_verdict.pattern"),
                "is_injection_attempt": F.col("_verdict.score") >= F.lit(float(threshold)),
            }
        )
        .drop("_verdict")
    )


def injection_summary(df: DataFrame, text_column: str, threshold: float = 0.5) -> DataFrame:
    """Texts, attempts and highest score per detected category."""
    return (
        detect_injections(df, text_column, threshold)
        .groupBy("injection_pattern")
        .agg(
            F.count("*").alias("texts"),
            F.count_if("is_injection_attempt").alias("attempts"),
            F.max("injection_risk_score").alias("max_score"),
        )
    )
