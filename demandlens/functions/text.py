"""Text expressions: fallbacks, display names, keyword classification."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlens.rules import Roles


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def slug_to_name(slug: str | Column) -> Column:
    """``data-lake_house`` becomes ``Data Lake House``."""
    return F.initcap(F.regexp_replace(slug, "[-_]", " "))


def classify(text: Column, rules, default: str) -> Column:
    """Label of the first rule with a keyword inside ``text``, else ``default``."""
    tests = [(label, reduce(or_, [text.contains(word) for word in words])) for label, words in rules]
    (label, test), *rest = tests
    chain = F.when(test, F.lit(label))
    for label, test in rest:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(default))


def role_name(roles: Roles = Roles()) -> Column:
    """Role of a posting by its normalized title, or its own where that is blank."""
    title = F.coalesce(blank_to_null("normalized_title"), "job_title", F.lit(""))
    return classify(F.lower(title), roles.rules, roles.default)
