"""Column expressions on page titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_key(col: Column) -> Column:
    """The key under which a written title is looked up.

    Everything from the first '#' is cut, underscores are blanks, outer blanks are dropped, runs of blanks are one
    blank and the first letter's case is ignored. Null when nothing is left.
    """
    text = F.regexp_replace(F.regexp_replace(col, r"(?s)#.*", ""), r"[_\s]+", " ")
    text = F.trim(text)
    return F.when(text != "", F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 2147483647)))


#: The same rule in SQL; ``{c}`` is the column.
TITLE_KEY_SQL = r"""(CASE WHEN trim(regexp_replace(regexp_replace({c}, '(?s)#.*', ''), '[_\s]+', ' ', 'g')) <> ''
 THEN lower(substr(trim(regexp_replace(regexp_replace({c}, '(?s)#.*', ''), '[_\s]+', ' ', 'g')), 1, 1))
 || substr(trim(regexp_replace(regexp_replace({c}, '(?s)#.*', ''), '[_\s]+', ' ', 'g')), 2) END)"""


# Months as they are written in titles and dates.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
SHORT_MONTHS = ("Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# Prefixes of pages that are not articles.
META_PREFIXES = ("Wikipedia:", "Portal:", "File:", "MediaWiki:", "Category:", "UN/LOCODE:", "Book:", "Help:", "P:", "List of ")

_USELESS = "(?i)^(" + "|".join((f"(?:{'|'.join(MONTHS + SHORT_MONTHS)})\\s+\\d{{1,2}}", "\\d{4}(?:\\s+BC)?", "\\d+", "\\d+\\s+\\(number\\)", "|".join(MONTHS))) + ")$"


def useful_title(col: Column) -> Column:
    """Titles of articles: no colon, and not a whole number, year, month, date or number page. Null for null."""
    return ~col.contains(":") & ~col.rlike(_USELESS)


def invalid_title(col: Column) -> Column:
    """Titles that the plain link scan leaves out: colon or '#', disambiguation, a year, or starting with a month."""
    return col.rlike("[:#]|disambiguation|^\\d{4}$|^\\d{4} in|^(?:" + "|".join(MONTHS) + ")\\b")


def is_meta_page(col: Column) -> Column:
    """Pages that are not articles by their prefix."""
    out = F.lit(False)
    for prefix in META_PREFIXES:
        out = out | col.startswith(prefix)
    return out


def looks_like_entity(col: Column) -> Column:
    """Titles of up to five words none of which is 'List' or starts in lower case (but for joining words)."""
    words = F.filter(F.split(col, "\\s+"), lambda w: w != "")
    bad = F.exists(words, lambda w: (w == "List") | (w.rlike("^[a-z]") & ~w.isin("of", "in", "the", "with", "for", "or", "and")))
    return ~bad & (F.size(words) < 6)


def sanitize_title(col: Column) -> Column:
    """A title without outer white space and with blanks for tabs, line ends and underscores."""
    return F.translate(F.regexp_replace(col, "^[\\s_]+|[\\s_]+$", ""), "\r\n\t_", "    ")


def strip_parenthetical(col: Column) -> Column:
    """A title without a closing part in parentheses; titles that start with one are kept."""
    return F.when(col.startswith("("), col).otherwise(F.regexp_replace(col, "\\s*\\([^(]+\\)$", ""))


def lower_alias(col: Column) -> Column:
    """The lower-case alias of a title whose first letter is upper and second is lower case, else null."""
    return F.when(col.rlike("^[A-Z][a-z]"), F.lower(col))


def bucket(col: Column) -> Column:
    """First letter or digit in upper case, '_' for anything else."""
    first = F.upper(F.substring(col, 1, 1))
    return F.when(first.rlike("^[A-Z0-9]$"), first).otherwise("_")


def listing_key(col: Column) -> Column:
    """Form in which listed titles are told apart: upper case, only letters, digits and blanks."""
    return F.regexp_replace(F.upper(col), "[^ A-Z0-9]", "")


def resource_title(col: Column) -> Column:
    """The title in a resource address of an ontology triple, else null."""
    name = F.regexp_extract(col, "^<http://dbpedia\\.org/resource/([^>]*)>", 1)
    return F.when(name != "", name)


def page_is_ambiguous(title: Column, templates: Column) -> Column:
    """Disambiguation pages by title or by a template among ``templates`` (array of names)."""
    return title.endswith("(disambiguation)") | F.exists(templates, lambda t: F.lower(t).isin("disambig", "disambiguation"))
