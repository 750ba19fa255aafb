"""Control samples: classification by name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import strip

NEGATIVE = "negative control"
POSITIVE = "positive control"
UNCLASSIFIED = "unclassified-control-like"

# Name patterns in order (first match wins, anchored at the start, any case)
# with category, negative type, positive type, rule name and whether it is an inference.
CONTROL_PATTERNS = (
    (r"blank[\s_-]*ext", NEGATIVE, "extraction negative", None, "blank-ext", None),
    (r"blank[\s_-]*pcr", NEGATIVE, "PCR negative", None, "blank-pcr", None),
    (r"pcr[\s_-]*nc\b", NEGATIVE, "PCR negative", None, "pcr-nc", None),
    (r"ext[\s_-]*nc\b", NEGATIVE, "extraction negative", None, "ext-nc", None),
    (r"cpcr", NEGATIVE, "PCR negative", None, "cpcr", None),
    (r"cneg", NEGATIVE, "PCR negative", None, "cneg", None),
    (r"cext", NEGATIVE, "extraction negative", None, "cext", None),
    (r"cmet", NEGATIVE, "process negative", None, "cmet", "process negative is an inference"),
    (
        r"(cpos|pos[\s_-]*c|mock)",
        POSITIVE,
        None,
        "other: positive/mock control",
        "positive",
        "generic positive control type",
    ),
    (r"water\b", NEGATIVE, "other: water control", None, "water", "water control type is generic"),
    (r"blank", NEGATIVE, "other: unspecified blank", None, "blank-bare", "blank without a type"),
)

# Fixed value: a name that looks like a control though no pattern matches.
CONTROL_LIKE = r"(blank|neg|ctrl|control|\bnc\b|_nc|nc_|water)"

CONTROL_TYPE = (
    "struct<samp_category:string,neg_cont_type:string,pos_cont_type:string,rule:string,"
    "warn_reason:string>"
)


def classify_control(name: Column | str) -> Column:
    """Struct of category, control types, matched rule and a reason to check by hand."""
    clean = F.coalesce(strip(name), F.lit(""))

    def result(category, neg, pos, rule, warn) -> Column:
        parts = {
            "samp_category": category,
            "neg_cont_type": neg,
            "pos_cont_type": pos,
            "rule": rule,
            "warn_reason": warn,
        }
        return F.struct(*[F.lit(v).cast("string").alias(k) for k, v in parts.items()])

    chain = None
    for pattern, *fields in CONTROL_PATTERNS:
        test = clean.rlike(f"(?i)^{pattern}")
        chain = F.when(test, result(*fields)) if chain is None else chain.when(test, result(*fields))
    like = result("sample", None, None, UNCLASSIFIED, "looks like a control, no known pattern")
    return chain.when(clean.rlike(f"(?i){CONTROL_LIKE}"), like).otherwise(
        result("sample", None, None, "sample", None)
    )


def _any_of(name: Column | str, categories: tuple[str, ...]) -> Column:
    """One pattern for a whole category: the ordered patterns never cross categories."""
    union = "|".join(p for p, category, *_ in CONTROL_PATTERNS if category in categories)
    return F.coalesce(strip(name).rlike(f"(?i)^(?:{union})"), F.lit(False))


def is_control(name: Column | str) -> Column:
    return _any_of(name, (NEGATIVE, POSITIVE))


def is_negative_control(name: Column | str) -> Column:
    """Negative controls only; positive controls are not used for screening."""
    return _any_of(name, (NEGATIVE,))


def is_extraction_negative(neg_cont_type: Column | str) -> Column:
    c = F.col(neg_cont_type) if isinstance(neg_cont_type, str) else neg_cont_type
    return F.coalesce(F.lower(c).contains("extraction"), F.lit(False))
