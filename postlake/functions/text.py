"""Text transforms (T1-T5, T7, T9) as Spark Column expressions.

All rules follow the Java string semantics of the reference:
``String.trim`` strips code points <= U+0020, ``String.split`` drops trailing
empty strings, ``List.toString`` renders ``[a, b]``.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's).
CLAUSE_DELIMITERS = r'[!?,.:;()"\[\]{}]+'      # clause splitting
REPLY_MAX_CHARS = 300                            # reply chunk length
NO_ROUTE_APOLOGY = ("Sorry, I couldn't find any relevant information for your query. "
                    "Please try asking me to talk about trending topics or summarizing posts..")
ANSWER_SYSTEM_PROMPT = (
    "You are a bot that helps users analyse posts about artificial intelligence posts. "
    "You may be given a data set to help you answer questions. Answer in a max od 300 chars. "
    "I MEAN IT. It's a TWEET. Don't write more than 300 chars. Respond in only ONE paragraph. "
    "Be as concise as possible")

_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def java_trim(c: Column) -> Column:
    """``String.trim()``: strip leading/trailing code points <= U+0020."""
    return F.regexp_replace(c, _JAVA_TRIM, "")


def java_list_string(arr: Column) -> Column:
    """``List.toString()``: ``[a, b]``; null elements print as ``null``."""
    return F.concat(F.lit("["), F.array_join(arr, ", ", "null"), F.lit("]"))


def split_clauses(text: Column) -> Column:
    """Split on runs of ``! ? , . : ; ( ) " [ ] { }``, trim, drop blanks."""
    parts = F.split(text, CLAUSE_DELIMITERS)
    return F.filter(F.transform(parts, java_trim), lambda s: s != F.lit(""))


def utf16_length(s: str) -> int:
    """Length as Java counts it: two units for characters beyond U+FFFF."""
    return len(s) + sum(c > "\uffff" for c in s) if not s.isascii() else len(s)


_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")
_TRIMMED = "".join(map(chr, range(33)))


def pack_words(text: str | None, max_len: int) -> list[str] | None:
    """One linear pass over the words of a text (see ``chunk_text``)."""
    if text is None:
        return None
    words = _BLANKS.split(text)
    while words and words[-1] == "" and len(words) > 1:
        words.pop()
    if text and words == [""]:
        return []
    out, cur, size = [], [], 0
    for w in words:
        n = utf16_length(w) + 1
        if size + n > max_len:
            out.append(" ".join(cur).strip(_TRIMMED))
            cur, size = [], 0
        cur.append(w)
        size += n
    out.append(" ".join(cur).strip(_TRIMMED))
    return out


def chunk_text(text: Column, max_len: int = REPLY_MAX_CHARS) -> Column:
    """Greedy word packing on ``\\s+`` (reference quirks kept).

    A word is appended with a trailing space; before appending, the current
    chunk is flushed (trimmed) when ``len(cur) + len(word) + 1 > max_len``.
    Lengths are in UTF-16 units, as in Java.  Hence trimmed chunks have at most
    ``max_len - 1`` units, an over-long first word emits an empty first chunk,
    and long words are never cut.  Trailing whitespace is removed first because
    Java's ``split`` drops the trailing empty string; an all-blank text has no
    chunk.  The packing is sequential, so it is one pass per text in Arrow
    batches.
    """
    @F.pandas_udf("array<string>")
    def pack(texts: pd.Series) -> pd.Series:
        return pd.Series([pack_words(t, max_len) for t in texts])

    return pack(text)


def parse_topics(model_output: Column) -> Column:
    """Remove double quotes, split on commas, trim, drop empty (dups kept)."""
    parts = F.split(F.regexp_replace(model_output, '"', ""), ",")
    return F.filter(F.transform(parts, java_trim), lambda s: s != F.lit(""))


def strip_mention(text: Column, handle: str) -> Column:
    """T4: remove every occurrence of the bot handle, then trim."""
    return java_trim(F.replace(text, F.lit(handle), F.lit("")))


def format_reply(author_handle: Column, answer: Column) -> Column:
    """T5: ``@handle answer``."""
    return F.concat(F.lit("@"), author_handle, F.lit(" "), answer)


def parse_langs(langs_text: Column, legacy: bool = True) -> Column:
    """``[en, pt]`` text -> array.

    ``legacy=True`` reproduces the reference exactly: brackets removed anywhere,
    split on ``", "``; a missing value reads as ``[]`` -> ``[""]`` and a null
    list printed as ``null`` -> ``["null"]``.  ``legacy=False`` gives an empty
    array for missing/empty input.
    """
    raw = F.coalesce(langs_text, F.lit("[]"))
    body = F.regexp_replace(raw, r"[\[\]]", "")
    arr = F.split(body, ", ")
    # Java's split drops trailing empty strings (an unsplit input stays as is).
    pos = F.array_position(F.reverse(F.transform(arr, lambda s: s != F.lit(""))), F.lit(True))
    arr = (F.when(F.size(arr) == 1, arr)
            .when(pos == 0, F.array().cast("array<string>"))
            .otherwise(F.slice(arr, F.lit(1), (F.size(arr) - pos + 1).cast("int"))))
    if legacy:
        return arr
    return F.filter(arr, lambda s: s != F.lit(""))


def build_prompt(system: Column | str, data: Column, user_text: Column,
                 data_prefix: str = "Enriching data: ", user_prefix: str = "User query: ",
                 data_role: str = "system") -> Column:
    """Ordered role/content messages for one model call."""
    sys_c = F.lit(system) if isinstance(system, str) else system
    msg = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(msg("system", sys_c),
                   msg(data_role, F.concat(F.lit(data_prefix), java_list_string(data))),
                   msg("user", F.concat(F.lit(user_prefix), user_text)))
