"""DuckDB SQL fragments mirroring ``functions.text`` (used by the oracles).

Each function takes an SQL expression string and returns an SQL expression
string with the same meaning as the Spark column of the same name.
DuckDB's ``regexp_replace`` replaces the first match unless ``'g'`` is given,
which is the reference's own default.
"""

from __future__ import annotations

from .functions import text as T


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unaccent_upper(x: str) -> str:
    for a, b in T.LIGATURES:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return f"upper(translate({x}, {q(T.ACCENTED)}, {q(T.PLAIN)}))"


def squeeze_punct(x: str) -> str:
    pat = q("[' -]+")
    return f"regexp_replace({x}, {pat}, ' ', 'g')"


def nom_maj(x: str) -> str:
    return squeeze_punct(unaccent_upper(x))


def keep_alnum(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[^A-Z 0-9]', ' ', 'g'), ' +', ' ', 'g')"


def drop_articles(x: str) -> str:
    pat = "(^| )((" + T.alt(T.ARTICLES) + ") )*"
    return f"trim(regexp_replace({x}, {q(pat)}, ' ', 'g'))"


def light_court(x: str) -> str:
    return drop_articles(keep_alnum(x))


def first(x: str, pat: str, rep: str) -> str:
    """First-only replace; ``rep`` uses ``\\n`` group references."""
    return f"regexp_replace({x}, {q(pat)}, {q(rep)})"


def glob(x: str, pat: str, rep: str) -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def trigrams(x: str) -> str:
    """Set of padded trigrams of the lower-cased alphanumeric words."""
    words = f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> '')"
    return ("list_distinct(flatten(list_transform(" + words +
            ", lambda w: list_transform(range(1, length(w) + 2), "
            "lambda i: substr('  ' || w || ' ', i, 3)))))")


def trigram_distance_lists(a: str, b: str) -> str:
    inter = f"len(list_intersect({a}, {b}))"
    union = f"(len({a}) + len({b}) - {inter})"
    sim = f"CASE WHEN {union} = 0 THEN CAST(0 AS FLOAT) ELSE CAST(CAST({inter} AS DOUBLE) / {union} AS FLOAT) END"
    return f"CAST(CAST(1 AS FLOAT) - {sim} AS FLOAT)"


def pad8(x: str) -> str:
    return f"right('0000000' || {x}, 8)"
