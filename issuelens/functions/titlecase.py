"""R-style title casing (``tools::toTitleCase``) as one JVM-side column expression.

The reference normalises status names with base R's title case before summing, so
``"in progress"`` and ``"In Progress"`` fall into the same bucket.  Spark's ``initcap``
is not the same rule (it lower-cases the rest of each word and capitalises small words),
so the rule is rebuilt with ``regexp_extract_all`` + ``transform`` over the tokens.  It
runs in the JVM with no Python involved; the lambda itself is evaluated by Spark's
interpreter, as all higher-order functions are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# The word lists and patterns of R's tools::toTitleCase, stated as in R.
# Words that are left exactly as written:
ALONE_WORDS = [
    "2D", "3D", "API", "BibTeX", "BioConductor", "CRAN", "CRAN's", "GitHub", "GUI", "HTML",
    "JavaScript", "LaTeX", "OpenBUGS", "TeX", "URL", "URLs", "WinBUGS", "XML",
]
# Words whose case is not touched either:
EITHER_WORDS = [
    "all", "above", "after", "along", "also", "among", "any", "both", "can", "few", "it",
    "less", "log", "many", "may", "more", "over", "some", "their", "then", "this", "under",
    "until", "using", "von", "when", "where", "which", "will", "without", "yet", "you", "your",
]
# Small words, lower case except as the first word (matched case-insensitively):
SMALL_WORDS = (
    "a|an|and|are|as|at|be|but|by|en|for|if|in|is|nor|not|of|on|or|per|so|the|to|v[.]?|via"
    "|vs[.]?|from|into|than|that|with"
)
# Characters that split words; each one is also kept as a token of its own:
DELIMITERS = ' -/"()\n\t'
# ---------------------------------------------------------------------------------------

_DELIM_CLASS = ' \\-/"()\\n\\t'
_TOKEN_PATTERN = f"[{_DELIM_CLASS}]|[^{_DELIM_CLASS}]+"
_SMALL_PATTERN = f"(?i)^({SMALL_WORDS})$"
_HAS_CAPS_PATTERN = "(?s)^\\p{L}.*\\p{Lu}"
_QUOTED_PATTERN = "(?s)^'.*'$"
_AFTER_COLON_PATTERN = "[-:]$"
_WORD_START_PATTERN = "^['\\p{L}\\p{Nd}]"


def _upper_char(ch: Column) -> Column:
    # R's toupper maps one character to one character (simple case mapping); a letter
    # whose upper case is longer (German sharp s -> "SS") stays as it is.
    up = F.upper(ch)
    return F.when(F.char_length(up) == 1, up).otherwise(ch)


def _capitalise(w: Column) -> Column:
    first = F.substring(w, 1, 1)
    quoted = (F.char_length(w) >= 3) & first.isin("'", '"')
    return F.when(quoted, F.concat(first, _upper_char(F.substring(w, 2, 1)), w.substr(F.lit(3), F.char_length(w)))) \
        .otherwise(F.concat(_upper_char(first), w.substr(F.lit(2), F.char_length(w))))


def _token(w: Column, i: Column, toks: Column) -> Column:
    prev1 = F.when(i >= 1, F.get(toks, i - 1))
    prev2 = F.when(i >= 2, F.get(toks, i - 2))
    after_colon = F.coalesce(prev2.rlike(_AFTER_COLON_PATTERN) & (prev1 == F.lit(" "))
                             & w.rlike(_WORD_START_PATTERN), F.lit(False))
    after_quote = F.coalesce(prev1 == F.lit('"'), F.lit(False))
    small = (i > 0) & w.rlike(_SMALL_PATTERN) & ~after_colon & ~after_quote
    keep = (w.rlike(_HAS_CAPS_PATTERN) | (F.char_length(w) == 1)
            | w.isin(*ALONE_WORDS, *EITHER_WORDS) | w.rlike(_QUOTED_PATTERN))
    # Fast path: a one-character token (every delimiter) stays as written unless it is
    # one of the one-letter small words, which the general rule may lower-case.
    single = (F.char_length(w) == 1) & ~F.lower(w).isin("a", "v")
    return F.when(single, w).when(small, F.lower(w)).when(keep, w).otherwise(_capitalise(w))


def title_case(c: Column | str) -> Column:
    """``tools::toTitleCase`` on a string column; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN_PATTERN), 0)
    # Bind the token array to a lambda variable once, so neighbour lookups do not
    # re-tokenise the text for every token.
    joined = F.transform(
        F.array(tokens),
        lambda toks: F.array_join(F.transform(toks, lambda w, i: _token(w, i, toks)), ""),
    )
    return F.element_at(joined, 1)


def status_name(c: Column | str) -> Column:
    """Status normalisation of the time-in-status analytic: title case, then drop spaces.

    A missing status is named ``NA``, the name R gives that group.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.replace(title_case(c), F.lit(" "), F.lit("")), F.lit("NA"))
