"""Rule-based text normalisation (R1-R14): the default backend of batch inference.

The prompt's rule list is "ordered the way a regex pipeline would run"; its mechanical
parts are written here as a list of steps. Each step is either a regex replacement
(a pattern both Java's engine and RE2 read the same way) or one of a few structured
steps (retweet names, mention and hashtag tokens, final period). The same step list is
interpreted by Spark (``apply_rules``) and by the DuckDB oracle (``tidewrack.oracles``).

Parts that need a language model (pronoun re-targeting, verb agreement) are left to a
custom inference backend (``operators.infer``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import WS

# --- fixed values ---------------------------------------------------------------------
LEAD_IN_TAGS = ("FLASHBACK", "BREAKING", "ICYMI")
SELF_NAMES = ("Donald J\\. Trump", "Donald Trump", "DJT", "Trump")  # regex-escaped
SELF_HANDLE = "realDonaldTrump"
NOISE_HASHTAGS = ("news", "update")
# ----------------------------------------------------------------------------------------

_W = f"[{WS}]"
_NAMES = "|".join(SELF_NAMES)
_DASH = "(?:--|-|–|—)"

# (kind, pattern, replacement); replacement uses $n group references.
STEPS: list[tuple[str, str, str]] = [
    # One paragraph.
    ("re", f"{_W}+", " "),
    ("re", f"^{_W}+|{_W}+\\z", ""),
    # R2: lead-in tags.
    ("re", f"^(?:{'|'.join(LEAD_IN_TAGS)}){_W}*[:–-]{_W}*", ""),
    # URLs plus the spaces before them.
    ("re", f"{_W}*(?:https?|ftp)://[^{WS}]+", ""),
    # Retweet prefix; the poster's names become first person (retweets only).
    ("rt_names", "", ""),
    # Self-attribution tails.
    ("re", f"{_W}*{_DASH}{_W}*Donald J\\. Trump{_W}*\\z", ""),
    ("re", f"{_W}*says Donald Trump{_W}*\\z", ""),
    ("re", f"{_W}*via @{SELF_HANDLE}{_W}*\\z", ""),
    # Quotation + attribution -> the quotation; attribution tails to a handle.
    ("re", f'^"([^"]+)"{_W}*(?:via|{_DASH}){_W}*[^"]*\\z', "$1"),
    ("re", f'^"([^"]+)"(?:{_W}+@[A-Za-z0-9_]+)+{_W}*\\z', "$1"),
    ("re", f"{_W}*(?:via|{_DASH}){_W}*@[A-Za-z0-9_]+{_W}*\\z", ""),
    # No quotes around the whole output.
    ("re", '^"([^"]*)"\\z', "$1"),
    # Leading @mention -> spaced name and a comma.
    ("lead_mention", "", ""),
    # Other @mentions -> spaced names.
    ("mentions", "", ""),
    # Hashtags.
    ("hashtags", "", ""),
    # Punctuation and spacing.
    ("re", " -- ", ". "),
    ("re", " - ", ". "),
    ("re", " @ ", " at "),
    ("re", "(^| )w/over( |\\z)", "$1with over$2"),
    ("re", "(^| )w/ ?", "$1with "),
    # Twice: a match takes the letter that the next one begins with.
    ("re", "([A-Za-z]),([A-Za-z])", "$1, $2"),
    ("re", "([A-Za-z]),([A-Za-z])", "$1, $2"),
    ("re", "([a-z])\\.([A-Z])", "$1. $2"),
    ("re", f"{_W}+([,.!?;:])", "$1"),
    ("re", f"{_W}+", " "),
    ("re", f"^{_W}+|{_W}+\\z", ""),
    # Final period when missing.
    ("final_period", "", ""),
]

# Cheap exact pre-tests (on UTF-8 bytes, no regex): a step whose guard is false cannot
# match, so it is skipped. Index -> list of literals of which one must occur
# ("^x" = starts with x). Steps without a guard always run. After step 0 the only
# whitespace left is the plain space, which the guards rely on.
GUARDS: dict[int, tuple[str, ...]] = {
    2: tuple("^" + t for t in LEAD_IN_TAGS),
    3: ("://",),
    5: ("Donald J. Trump",),
    6: ("says Donald Trump",),
    7: (f"via @{SELF_HANDLE}",),
    8: ('^"',),
    9: ('^"',),
    10: ("@",),
    11: ('^"',),
    15: (" -- ",),
    16: (" - ",),
    17: (" @ ",),
    18: ("w/over",),
    19: ("w/",),
    20: (",",),
    21: (",",),
    22: (".",),
}

CAMEL_STEPS = [("_", " "), ("([a-z0-9])([A-Z])", "$1 $2"), ("([A-Z])([A-Z][a-z])", "$1 $2")]
INITIAL_STEP = ("(^| )([A-Z])( |\\z)", "$1$2.$3")
RT_PREFIX = f"^RT{_W}+@[A-Za-z0-9_]+:?{_W}*"
MENTION = "^@([A-Za-z0-9_]+)(.*)\\z"
HASHTAG = "^#([A-Za-z0-9_]+)(.*)\\z"
ACRONYM_OR_WORD = "^(?:[A-Z0-9]+|[A-Za-z][a-z0-9]*)\\z"
FINAL_MARK = "[.!?][\"')\\]]*\\z"


def camel_words(c: Column, initials: bool = True) -> Column:
    for pat, rep in CAMEL_STEPS:
        c = F.regexp_replace(c, pat, rep)
    if initials:
        # Twice: neighbouring initials share the space between them.
        c = F.regexp_replace(F.regexp_replace(c, *INITIAL_STEP), *INITIAL_STEP)
    return c


def _mention_token(t: Column) -> Column:
    name = F.regexp_extract(t, MENTION, 1)
    rest = F.regexp_extract(t, MENTION, 2)
    return F.when(t.rlike(MENTION), F.concat(camel_words(name), rest)).otherwise(t)


def _hashtag_token(t: Column) -> Column:
    body = F.regexp_extract(t, HASHTAG, 1)
    rest = F.regexp_extract(t, HASHTAG, 2)
    noise = F.lower(body).isin(*NOISE_HASHTAGS)
    plain = body.rlike(ACRONYM_OR_WORD)
    word = F.when(noise, rest).when(plain, F.concat(body, rest)).otherwise(
        F.concat(F.lower(camel_words(body, initials=False)), rest))
    return F.when(t.rlike(HASHTAG), word).otherwise(t)


def _step(kind: str, pat: str, rep: str, c: Column) -> Column:
    if kind == "re":
        return F.regexp_replace(c, pat, rep)
    if kind == "rt_names":
        is_rt = c.startswith("RT") & c.rlike(RT_PREFIX)
        body = F.regexp_replace(c, RT_PREFIX, "")
        named = F.regexp_replace(F.regexp_replace(body, f"\\b(?:{_NAMES})'s\\b", "my"), f"\\b(?:{_NAMES})\\b", "me")
        return F.when(is_rt, named).otherwise(c)
    if kind == "lead_mention":
        name = F.regexp_extract(c, "^@([A-Za-z0-9_]+)", 1)
        rest = F.regexp_replace(c, f"^@[A-Za-z0-9_]+[:,]?{_W}*", "")
        return F.when(c.startswith("@") & (name != ""), F.concat(camel_words(name), F.lit(", "), rest)).otherwise(c)
    if kind == "mentions":
        # Only texts holding an '@' are split into words (same result, far less work).
        return F.when(c.contains("@"), F.array_join(F.transform(F.split(c, " "), _mention_token), " ")).otherwise(c)
    if kind == "hashtags":
        return F.when(c.contains("#"), F.array_join(F.transform(F.split(c, " "), _hashtag_token), " ")).otherwise(c)
    if kind == "final_period":
        return F.when((c != "") & ~c.rlike(FINAL_MARK), F.concat(c, F.lit("."))).otherwise(c)
    raise ValueError(kind)


def _guard(c: Column, lits: tuple[str, ...]) -> Column:
    tests = [c.startswith(x[1:]) if x.startswith("^") else c.contains(x) for x in lits]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


# --- fixed values: the words that the rules themselves may put in (R13) ----------------
LITERALS = ("me", "my", "at", "with")
# ----------------------------------------------------------------------------------------
WORD = r"[\p{L}\p{N}]+"
NO_WORD = r"[^\p{L}\p{N}]+"


def new_words(source: str, out: str) -> Column:
    """R13 (no new facts): the distinct words of ``out``, sorted, that neither stand in
    ``source``, whole or inside its run of letters and digits (``@CamelName``), nor among
    ``LITERALS``. Only words that are not whole words of the source are looked up in it."""
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(WORD), F.lit(0))
    letters = F.regexp_replace(F.lower(F.coalesce(F.col(source), F.lit(""))), NO_WORD, "")
    left = F.array_except(words(out), F.concat(words(source), F.array(*map(F.lit, LITERALS))))
    return F.array_sort(F.filter(left, lambda w: ~F.contains(letters, w)))


def apply_rules(df: DataFrame, text: str, out: str = "clean_text") -> DataFrame:
    """Run the rule chain on ``text`` into ``out``. One projection per step; Spark keeps
    them separate where collapsing would repeat an expensive expression."""
    tmp = "_rule_t"
    df = df.withColumn(tmp, F.coalesce(F.col(text), F.lit("")))
    for i, (kind, pat, rep) in enumerate(STEPS):
        c = F.col(tmp)
        step = _step(kind, pat, rep, c)
        if i in GUARDS:
            step = F.when(_guard(c, GUARDS[i]), step).otherwise(c)
        df = df.withColumn(tmp, step)
    return df.withColumnRenamed(tmp, out) if out not in df.columns else df.withColumn(out, F.col(tmp)).drop(tmp)
