"""DuckDB (RE2) spellings of the column functions, for the oracle SQL of every query.

Each helper mirrors one function of ``tidewrack.functions.text`` on a SQL expression
string. They are only used to write the independent check queries.
"""

from __future__ import annotations

from tidewrack.functions.text import (
    DOUBLE_QUOTES, EN_DASH, LONG_DASHES, MEDIA_PLACEHOLDERS, SINGLE_QUOTES, TOKEN_PATTERN, URL_PATTERN, WS,
)
from tidewrack.sources.feed import FEED_SQL


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^[{WS}]+|[{WS}]+' + chr(92) + 'z')}, '', 'g')"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR length({strip(x)}) = 0)"


def collapse_whitespace(x: str) -> str:
    return strip(f"regexp_replace({x}, {lit(f'[{WS}]+')}, ' ', 'g')")


def normalise_punctuation(x: str) -> str:
    c = f"replace({x}, '…', '...')"
    c = f"translate({c}, {lit(SINGLE_QUOTES + DOUBLE_QUOTES + LONG_DASHES)}, {lit(chr(39) * 2 + chr(34) * 2 + EN_DASH * len(LONG_DASHES))})"
    c = f"replace({c}, {lit(chr(92) + 'n')}, ' ')"
    c = f"regexp_replace({c}, {lit(f'[{WS}]+')}, ' ', 'g')"
    return f"regexp_replace({c}, {lit(f'^[{WS}' + chr(92) + '-' + EN_DASH + ']+')}, '')"


def clean_feed_text(x: str) -> str:
    return normalise_punctuation(collapse_whitespace(x))


def drop_final_dot(x: str) -> str:
    return f"(CASE WHEN ends_with({x}, '.') THEN substr({x}, 1, length({x}) - 1) ELSE {x} END)"


def is_media(x: str) -> str:
    t = drop_final_dot(x)
    media = ", ".join(lit(m) for m in MEDIA_PLACEHOLDERS)
    return f"(regexp_matches({t}, {lit(r'^pic\.twitter\.com/[a-zA-Z0-9]+\z')}) OR {t} IN ({media}))"


def is_only_handle_repost(x: str) -> str:
    return f"regexp_matches({x}, {lit(f'^RT[{WS}]+@([a-zA-Z0-9_]+)' + r'\.?\z')})"


def is_url(x: str) -> str:
    squeezed = f"regexp_replace({drop_final_dot(x)}, {lit(f'[{WS}]+')}, '', 'g')"
    return (f"((starts_with({x}, 'http://') OR starts_with({x}, 'https://')) "
            f"AND regexp_matches({squeezed}, {lit(URL_PATTERN)}))")


def keep_feed_text(x: str) -> str:
    return f"(NOT {is_media(x)} AND NOT {is_only_handle_repost(x)} AND NOT {is_url(x)})"


def to_utc_iso(x: str) -> str:
    utc = f"(CAST({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"
    fraction = f"CASE WHEN microsecond({utc}) % 1000000 = 0 THEN '' ELSE strftime({utc}, '.%f') END"
    return f"(strftime({utc}, '%Y-%m-%dT%H:%M:%S') || {fraction} || 'Z')"


def content_id(d: str, t: str) -> str:
    return f"sha256({d} || {t})"


def clean_post_text(x: str) -> str:
    c = f"regexp_replace({x}, {lit(f'([{WS}]*:[{WS}]*)?https?://[^{WS}]+' + r'(\.\.\.)')}, '\\1\\2', 'g')"
    c = f"regexp_replace({c}, {lit(f'([{WS}]*:[{WS}]*)?https?://[^{WS}]+')}, '', 'g')"
    c = f"replace({c}, chr(10), ' ')"
    c = f"regexp_replace({c}, {lit(f'[{WS}]*' + r'(\.\.\.|,|;|\.|!|\?)' + f'[{WS},;.!?]*')}, '\\1 ', 'g')"
    c = f"regexp_replace({c}, {lit(f'[{WS}]+')}, ' ', 'g')"
    c = f"regexp_replace({c}, {lit(r'(\p{Nd}+[,.])' + f'[{WS}]' + r'(\p{Nd}+)')}, '\\1\\2', 'g')"
    c = f"regexp_replace({c}, {lit(r'([aApP])\. ([mM])')}, '\\1.\\2', 'g')"
    return strip(c)


def trim_backticks(x: str) -> str:
    c = f"(CASE WHEN starts_with({x}, '`') THEN substr({x}, 2) ELSE {x} END)"
    return f"(CASE WHEN ends_with({c}, '`') THEN substr({c}, 1, length({c}) - 1) ELSE {c} END)"


def word_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(TOKEN_PATTERN)})"


def strip_leading_dots(x: str) -> str:
    return f"regexp_replace({x}, {lit(r'^\.+' + f'[{WS}]*')}, '')"


FEED = f"feed AS ({FEED_SQL})"
CLEANED = f"""cleaned AS (
  SELECT page, pos, date, platform, deleted_flag, {clean_feed_text('text')} AS text
  FROM feed WHERE text IS NOT NULL)"""
KEPT = f"kept AS (SELECT * FROM cleaned WHERE {keep_feed_text('text')})"
MERGED = f"""isl AS (
  SELECT *, sum(CASE WHEN starts_with(text, '...') THEN 0 ELSE 1 END)
              OVER (ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS island FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY island ORDER BY page, pos) AS r FROM isl),
merged AS (
  SELECT arg_min(page, r) AS page, arg_min(pos, r) AS pos, arg_min(date, r) AS date,
         string_agg(CASE WHEN r = 1 THEN text ELSE {strip_leading_dots('text')} END, ' ' ORDER BY r) AS text,
         CAST(count(*) AS BIGINT) AS n_parts
  FROM ranked GROUP BY island)"""
KEYED = f"""keyed AS (
  SELECT {content_id('date', 'text')} AS id, {to_utc_iso('date')} AS date, text AS raw_text, page, pos
  FROM merged WHERE NOT {is_blank('text')})"""
POSTS = """posts AS (
  SELECT id, arg_min(date, (page, pos)) AS date, arg_min(raw_text, (page, pos)) AS raw_text,
         arg_min(page, (page, pos)) AS page, arg_min(pos, (page, pos)) AS pos
  FROM keyed GROUP BY id)"""


def with_posts(*extra: str) -> str:
    """WITH clause that defines feed -> cleaned -> kept -> merged -> keyed -> posts."""
    return "WITH " + ",\n".join([FEED, CLEANED, KEPT, MERGED, KEYED, POSTS, *extra])


# --- rule chain (R1-R14) as a CTE chain ------------------------------------------------

def _rep(r: str) -> str:
    import re as _re
    return _re.sub(r"\$(\d)", r"\\\1", r)


def _camel(x: str, initials: bool = True) -> str:
    from tidewrack.functions.rules import CAMEL_STEPS, INITIAL_STEP
    steps = CAMEL_STEPS + ([INITIAL_STEP, INITIAL_STEP] if initials else [])
    for pat, rep in steps:
        x = f"regexp_replace({x}, {lit(pat)}, {lit(_rep(rep))}, 'g')"
    return x


def _rule_step(kind: str, pat: str, rep: str, t: str) -> str:
    from tidewrack.functions import rules as R
    if kind == "re":
        return f"regexp_replace({t}, {lit(pat)}, {lit(_rep(rep))}, 'g')"
    if kind == "rt_names":
        body = f"regexp_replace({t}, {lit(R.RT_PREFIX)}, '')"
        names = "|".join(R.SELF_NAMES)
        named = f"regexp_replace(regexp_replace({body}, {lit(chr(92) + 'b(?:' + names + ')' + chr(39) + 's' + chr(92) + 'b')}, 'my', 'g'), {lit(chr(92) + 'b(?:' + names + ')' + chr(92) + 'b')}, 'me', 'g')"
        return f"CASE WHEN regexp_matches({t}, {lit(R.RT_PREFIX)}) THEN {named} ELSE {t} END"
    if kind == "lead_mention":
        name = f"regexp_extract({t}, '^@([A-Za-z0-9_]+)', 1)"
        rest = f"regexp_replace({t}, {lit('^@[A-Za-z0-9_]+[:,]?[' + WS + ']*')}, '')"
        return f"CASE WHEN {name} <> '' THEN {_camel(name)} || ', ' || {rest} ELSE {t} END"
    if kind == "mentions":
        tok = (f"CASE WHEN regexp_matches(w, {lit(R.MENTION)}) THEN {_camel(f'regexp_extract(w, {lit(R.MENTION)}, 1)')}"
               f" || regexp_extract(w, {lit(R.MENTION)}, 2) ELSE w END")
        return f"array_to_string(list_transform(string_split({t}, ' '), lambda w: {tok}), ' ')"
    if kind == "hashtags":
        body = f"regexp_extract(w, {lit(R.HASHTAG)}, 1)"
        rest = f"regexp_extract(w, {lit(R.HASHTAG)}, 2)"
        noise = ", ".join(lit(n) for n in R.NOISE_HASHTAGS)
        word = (f"CASE WHEN lower({body}) IN ({noise}) THEN {rest} "
                f"WHEN regexp_matches({body}, {lit(R.ACRONYM_OR_WORD)}) THEN {body} || {rest} "
                f"ELSE lower({_camel(body, False)}) || {rest} END")
        tok = f"CASE WHEN regexp_matches(w, {lit(R.HASHTAG)}) THEN {word} ELSE w END"
        return f"array_to_string(list_transform(string_split({t}, ' '), lambda w: {tok}), ' ')"
    if kind == "final_period":
        return f"CASE WHEN {t} <> '' AND NOT regexp_matches({t}, {lit(R.FINAL_MARK)}) THEN {t} || '.' ELSE {t} END"
    raise ValueError(kind)


def rules_ctes(src: str, keys: str, text_expr: str, prefix: str = "rr") -> tuple[list[str], str]:
    """CTEs applying the rule chain to ``text_expr`` of ``src``; returns (ctes, last name).
    The last CTE has ``keys``, ``t`` (rule output) and ``src_text`` (input)."""
    from tidewrack.functions.rules import STEPS
    ctes = [f"{prefix}0 AS (SELECT {keys}, {text_expr} AS src_text, coalesce({text_expr}, '') AS t FROM {src})"]
    for i, step in enumerate(STEPS, 1):
        ctes.append(f"{prefix}{i} AS (SELECT {keys}, src_text, {_rule_step(*step, 't')} AS t FROM {prefix}{i - 1})")
    return ctes, f"{prefix}{len(STEPS)}"


def normalised(src: str, keys: str, text_expr: str, prefix: str = "rr") -> tuple[list[str], str]:
    """Rule chain plus the blank short-circuit; last CTE has ``keys`` and ``clean_text``."""
    ctes, last = rules_ctes(src, keys, text_expr, prefix)
    ctes.append(f"{prefix}_out AS (SELECT {keys}, CASE WHEN {is_blank('src_text')} THEN '' ELSE t END AS clean_text FROM {last})")
    return ctes, f"{prefix}_out"


# --- subword ids (F10): pair merges by rank as a recursive CTE over the distinct pretokens ---

#: Unicode white space, as a class of RE2.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_EDGE = "\x1f"  # stands before the last of several white-space characters in front of a word
_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\x1f\p{{L}}\p{{N}}]+|[{SPACE}]+|\x1f"


def bpe(src: str, key: str, text: str, ranks_path: str) -> str:
    """CTEs ending in ``bpe_ids(key, ids)``. Bytes are hexadecimal strings here. The text's
    own U+001F takes the place of U+001E meanwhile, which is split alike."""
    marked = f"regexp_replace(replace(coalesce({text}, ''), chr(31), chr(30)), {lit(f'([{SPACE}]+)([{SPACE}])([^{SPACE}])')}, {lit(chr(92) + '1' + _EDGE + chr(92) + '2' + chr(92) + '3')}, 'g')"
    return f"""ranks AS MATERIALIZED (SELECT hex(from_base64(token)) AS token, rank FROM read_csv({lit(ranks_path)}, delim=' ', header=false, quote='', escape='', columns={{'token': 'VARCHAR', 'rank': 'BIGINT'}})),
pre AS MATERIALIZED (SELECT {key}, list_filter(regexp_extract_all({marked}, {lit(_WORDS)}), lambda w: w <> chr(31)) AS words FROM {src}),
word AS (SELECT DISTINCT unnest(words) AS word FROM pre),
merging AS (
  SELECT word, regexp_extract_all(hex(encode(word)), '..') AS parts, 0 AS n FROM word
  UNION ALL
  SELECT word, parts[:best.i - 1] || [parts[best.i] || parts[best.i + 1]] || parts[best.i + 2:], n + 1 FROM (
    SELECT word, any_value(parts) AS parts, any_value(n) AS n, min({{'rank': rank, 'i': i}}) AS best FROM (
      SELECT word, parts, n, unnest(range(1, len(parts))) AS i FROM merging) p
    JOIN ranks ON ranks.token = p.parts[i] || p.parts[i + 1] GROUP BY word)),
last_parts AS (SELECT word, arg_max(parts, n) AS parts FROM merging GROUP BY word),
part AS (SELECT word, unnest(parts) AS token, generate_subscripts(parts, 1) AS i FROM last_parts),
word_ids AS MATERIALIZED (SELECT word, list(rank ORDER BY i) AS ids FROM part JOIN ranks USING (token) GROUP BY word),
placed AS (SELECT {key}, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM pre),
bpe_found AS (SELECT {key}, flatten(list(ids ORDER BY p)) AS ids FROM placed JOIN word_ids USING (word) GROUP BY {key}),
bpe_ids AS (SELECT pre.{key}, coalesce(ids, []) AS ids FROM pre LEFT JOIN bpe_found ON pre.{key} = bpe_found.{key})"""
