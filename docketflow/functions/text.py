"""Text columns (I1-I18, C17, C19, C20). All run inside the JVM unless said otherwise."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"  # beside the space
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: Words kept small inside re-cased titles, and acronyms kept whole.
SMALL_WORDS = {"a", "an", "and", "as", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with"}
ACRONYMS = {"U.S.", "US", "USA", "EPA", "FAA", "FCC", "FDA", "FERC", "IRS", "NASA", "NOAA", "SEC", "DHS", "DOE", "DOJ", "DOT", "II", "III", "IV"}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def one_line(s: Column | str) -> Column:
    """Each run of Unicode white space becomes one space; trimmed. All white space is translated to spaces first, so
    that texts without runs need no pattern."""
    plain = F.translate(_c(s), WHITE, " " * len(WHITE))
    return F.trim(F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain))


def truncate(s: Column | str, n: int) -> Column:
    """At most n characters, with an ellipsis in place of what is cut."""
    s = _c(s)
    return F.when(F.length(s) > n, F.concat(F.rtrim(F.substring(s, 1, n - 1)), F.lit("…"))).otherwise(s)


def first_line(s: Column | str) -> Column:
    """The first line that is not blank, trimmed; null if there is none."""
    lines = F.filter(F.split(_c(s), "\n"), lambda x: F.trim(x) != "")
    return F.trim(F.try_element_at(lines, F.lit(1)))


def sentence_clip(s: Column | str, n: int, note: str = "") -> Column:
    """I4: texts over n characters end at the last sentence end inside n, else at n; then the note."""
    s = _c(s)
    head = F.substring(s, 1, n)
    cut = F.regexp_extract(head, r"^((?s).+[.?!]) ", 1)
    return F.when(F.length(s) <= n, s).otherwise(F.concat(F.when(cut != "", cut).otherwise(head), F.lit(note)))


def words(s: Column | str) -> Column:
    """Words between white space."""
    return F.filter(F.split(one_line(s), " "), lambda x: x != "")


def word_bounds(s: Column | str, least: int = 200, most: int = 500) -> Column:
    """Null under `least` words, the first `most` words above."""
    w = words(s)
    return F.when(F.size(w) < least, F.lit(None)).when(F.size(w) > most, F.array_join(F.slice(w, 1, most), " ")).otherwise(F.array_join(w, " "))


def mostly_capitals(s: Column | str, share: float = 0.8) -> Column:
    """Whether at least `share` of the letters are capitals."""
    s = _c(s)
    letters = F.length(F.regexp_replace(s, r"\P{L}", ""))
    return (letters > 0) & (F.length(F.regexp_replace(s, r"\P{Lu}", "")) >= share * letters)


@F.pandas_udf(StringType())
def recase(s: pd.Series) -> pd.Series:
    """Title case with small words and acronyms. A pandas UDF, as initcap lower-cases after apostrophes and dots."""

    def word(w: str, first: bool) -> str:
        if w.strip("(),.;:") in ACRONYMS or w in ACRONYMS:
            return w
        if not first and w.lower() in SMALL_WORDS:
            return w.lower()
        out, up = [], True
        for k, c in enumerate(w.lower()):
            out.append(c.upper() if up else c)
            # a letter after a hyphen is a capital; after an apostrophe only in names like O'Rourke
            up = c in "-/(\"" or (c in "'’" and k == 1)
            if not c.isalpha() and k == 0:
                up = True
        return "".join(out)

    def title(t: str | None) -> str | None:
        return None if t is None else " ".join(word(w, k == 0) for k, w in enumerate(t.split()))

    return s.map(title)


def display_title(s: Column | str) -> Column:
    """Titles in capitals re-cased, others as they are."""
    return F.when(mostly_capitals(s), recase(_c(s))).otherwise(_c(s))


def slug(s: Column | str) -> Column:
    """Lower case, runs of other than a-z0-9 become one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(s)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def normal_lines(s: Column | str) -> Column:
    """I8: lines right-trimmed, runs of blank lines become one, none at the ends."""
    t = F.regexp_replace(F.regexp_replace(_c(s), r"\r\n?", "\n"), r"[ \t\x0b\f]+(?=\n|$)", "")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def strip_prefix(s: Column | str, *prefixes: str) -> Column:
    """Title boilerplate taken off the start."""
    return F.regexp_replace(_c(s), "^(?:" + "|".join(prefixes) + r")\s*[,:;-]?\s*", "")


def purpose(s: Column | str) -> Column:
    """What stands before the first colon."""
    return F.split_part(_c(s), F.lit(":"), F.lit(1))


def redact(s: Column | str, mark: str = "[address]") -> Column:
    """E-mail addresses replaced."""
    return F.regexp_replace(_c(s), EMAIL, mark)


def ordinal(n: Column | str) -> Column:
    """1st, 2nd, 3rd, 4th, 11th."""
    n = _c(n)
    last = n % 10
    end = F.when((n % 100).between(11, 13), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)


def teaser(s: Column | str) -> Column:
    """The first sentence of the first paragraph that isn't a heading or a list."""
    lines = F.filter(F.split(_c(s), "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).rlike(r"^[#>*|-]"))
    line = F.trim(F.try_element_at(lines, F.lit(1)))
    sentence = F.regexp_extract(line, r"^(.+?[.?!])(?:\s|$)", 1)
    return F.when(sentence != "", sentence).otherwise(line)


def table_cell(s: Column | str) -> Column:
    """Safe inside a Markdown table."""
    return F.replace(F.replace(_c(s), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def xml_escape(s: Column | str) -> Column:
    """Safe inside XML."""
    out = F.replace(_c(s), F.lit("&"), F.lit("&amp;"))
    for raw, ref in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(ref))
    return out


def significant_words(s: Column | str, least: int = 5) -> Column:
    """I16: distinct lower-case words of `least` ASCII letters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_c(s)), F.lit(f"[a-z]{{{least},}}"), F.lit(0)))


def json_reply(s: Column | str) -> Column:
    """The JSON object of a reply, code fences taken off, as text; `{}` when it is none."""
    body = F.regexp_extract(F.regexp_replace(_c(s), r"(?m)^\s*```[a-z]*\s*$", ""), r"(?s)(\{.*\})", 1)
    parsed = F.to_json(F.try_parse_json(body))
    return F.coalesce(F.when(parsed.startswith("{"), parsed), F.lit("{}"))


def looks_like_prose(s: Column | str) -> Column:
    """C17: eight words or more, sentence punctuation, half of the words in lower case or more."""
    w = words(s)
    return (F.size(w) >= 8) & _c(s).rlike(r"[.!?](\s|$)") & (F.size(F.filter(w, lambda x: x.rlike("^[a-z]"))) * 2 >= F.size(w))


def administrative(subject: Column | str) -> Column:
    """Subjects of mail that manages a subscription."""
    return _c(subject).rlike(r"(?iu)\b(?:confirm(?:ation)?|subscri(?:be|bed|ption)|unsubscribe|verify your|password|preferences|welcome to)\b")


def strip_boilerplate(s: Column | str) -> Column:
    """C20: mail text up to its footer rule, without link and view-online lines."""
    lines = F.split(_c(s), "\n")
    rule = F.array_position(F.transform(lines, lambda x: F.trim(x).rlike(r"^(?:[-_=*]{5,})$")), True)
    kept = F.when(rule > 0, F.slice(lines, F.lit(1), F.greatest(rule - 1, F.lit(0)).cast("int"))).otherwise(lines)
    kept = F.filter(kept, lambda x: ~x.rlike(r"(?iu)unsubscribe|manage (?:your )?(?:preferences|subscriptions)|view (?:this )?(?:e-?mail|message)? ?(?:in|as) (?:a |your )?(?:browser|web ?page)"))
    return F.trim(F.array_join(kept, "\n"))


def after(s: Column | str, mark: str) -> Column:
    """What follows the first `mark`; all but the first character where there is none, as position 0 plus two has it."""
    s = _c(s)
    return F.substr(s, F.instr(s, F.lit(mark)) + len(mark))


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host in lower case and path of a logged URL, by its slashes."""
    rest = after(url, "//")
    slash = F.instr(rest, F.lit("/"))
    return F.lower(F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)), F.when(slash > 0, F.substr(rest, slash)).otherwise("/")
