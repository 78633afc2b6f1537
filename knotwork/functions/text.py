"""Column expressions on texts, names, addresses and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from knotwork.functions.titles import MONTHS


def clean_string(col: Column) -> Column:
    """One line of plain ASCII text: tags off, line ends and other letters to blanks, quotes escaped, blanks collapsed."""
    t = F.regexp_replace(F.trim(col), "<[^>]*>", "")
    t = F.regexp_replace(F.replace(F.regexp_replace(t, "\\n", " "), F.lit('"'), F.lit("&quot;")), "’", "'")
    return F.regexp_replace(F.regexp_replace(t, "[^\\x00-\\x7F]+", " "), "\\s+", " ")


def permalink_to_name(col: Column) -> Column:
    """Words of a permalink with capitals at their start and after dots; a last number goes in parentheses."""
    parts = F.split(col, "-")
    last = F.size(parts) - 1
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 10**6))
    word = lambda w: F.array_join(F.transform(F.split(w, "\\."), capital), ".")
    named = F.transform(parts, lambda w, i: F.when((i == last) & (last > 0) & w.rlike("^\\d+$"), F.concat(F.lit("("), w, F.lit(")"))).otherwise(word(w)))
    return F.array_join(named, " ")


def keyify(col: Column) -> Column:
    """Template titles as rule keys: lower case, the first underscore a blank."""
    return F.regexp_replace(F.lower(col), "^([^_]*)_", "$1 ")


def convert_to_query(col: Column) -> Column:
    """The telling words of a name of two to four capitalised words, in lower case; other texts whole in lower case."""
    p = F.split(col, "\\s+")
    n = F.size(p)
    at = lambda k: F.try_element_at(p, k)
    name = (n > 1) & (n < 5) & F.forall(p, lambda w: w.rlike("^[A-Z]")) & (F.length(at(F.lit(-1))) > 2)
    chosen = (
        F.when(col.rlike("\\.$"), F.regexp_replace(at(F.lit(-2)), "[,:;!]$", ""))
        .when(n > 3, F.concat_ws(" ", at(F.lit(1)), at(F.lit(2))))
        .when(at(F.lit(-1)).isin("University", "College"), F.array_join(F.slice(p, F.lit(1), F.greatest(n - 1, F.lit(0))), " "))
        .otherwise(at(F.lit(-1)))
    )
    return F.lower(F.when(name, chosen).otherwise(col))


def matches_acronym(text: Column, acronym: Column) -> Column:
    """Whether the capital initials of the words spell the acronym; words may not follow after its last letter."""
    words = F.split(text, "\\s+")
    capitals = F.filter(F.transform(words, lambda w: F.substring(w, 1, 1)), lambda c: c.rlike("[A-Z]"))
    return (F.array_join(capitals, "") == acronym) & F.try_element_at(words, F.lit(-1)).rlike("^[A-Z]")


def snippet_from_template(template: Column, title: Column, value: Column) -> Column:
    """A rule's sentence with [[T]] and [[X]] filled in and an end."""
    first = lambda t, mark, new: F.when(F.instr(t, mark) > 0, F.concat(F.substring_index(t, mark, 1), F.lit("[["), new, F.lit("]]"), F.substring(t, F.instr(t, mark) + 5, F.lit(10**6)))).otherwise(t)
    out = first(first(template, "[[T]]", title), "[[X]]", value)
    return F.when(out.rlike("[.?!]$"), out).otherwise(F.concat(out, F.lit(".")))


def url_encode(col: Column) -> Column:
    """Percent encoding that keeps A-Z a-z 0-9 - _ . ~ ! * ( ) '."""
    t = F.url_encode(col)
    for a, b in (("+", "%20"), ("%28", "("), ("%29", ")"), ("%21", "!"), ("%27", "'"), ("%7E", "~")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def parse_query(col: Column) -> Column:
    """A query string as a map of decoded names and values; of repeated names the last counts."""
    pairs = F.filter(F.split(col, "&"), lambda x: x != "")
    entry = lambda x: F.struct(F.url_decode(F.substring_index(x, "=", 1)).alias("key"), F.url_decode(F.when(F.instr(x, "=") > 0, F.substring(x, F.instr(x, "=") + 1, F.lit(10**6))).otherwise("")).alias("value"))
    entries = F.transform(pairs, entry)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda l: l["key"] == e["key"]))
    return F.map_from_entries(last)


def web_site(col: Column) -> Column:
    """An address with scheme and host in lower case; null when it is none."""
    ok = col.rlike("(?i)^https?://[^.]+\\.[^.]+")
    head = F.regexp_extract(col, "^([^/]*//[^/]*)", 1)
    return F.when(ok, F.concat(F.lower(head), F.substring(col, F.length(head) + 1, F.lit(10**6))))


def twitter_url(col: Column) -> Column:
    """The address of a handle of letters, digits and underscores, else null."""
    return F.when(col.rlike("^\\w+$"), F.concat(F.lit("http://twitter.com/"), col))


def preprocess(content: Column, title: Column, site: str = "Wikipedia", server: str = "http://en.wikipedia.org") -> Column:
    """Page source without comments and with the magic words filled in."""
    t = F.regexp_replace(content, "(?s)<!--.*?-->", "")
    for mark, new in (("{{SITENAME}}", F.lit(site)), ("{{SERVER}}", F.lit(server)), ("{{PAGENAME}}", title)):
        t = F.replace(t, F.lit(mark), new)
    return t


def image_path(title: Column) -> Column:
    """The place of an image by the MD5 of its name: /h/hh/name."""
    name = F.translate(title, " ", "_")
    h = F.md5(name)
    return F.concat(F.lit("/"), F.substring(h, 1, 1), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), name)


def image_name(col: Column) -> Column:
    """The image file that a parameter value starts with, else null."""
    name = F.regexp_extract(col, "(?i)^\\s*([^ \\[{\\s][ -~]+\\.(?:jpg|jpeg|svg|gif|png))", 1)
    return F.when(name != "", name)


def category_image(col: Column) -> Column:
    """Whether a page title names an image file."""
    return col.rlike("(?i)\\.(jpg|png|gif|jpeg)$")


def month_name(number: Column) -> Column:
    """English name of a month number, null outside 1 to 12."""
    return F.try_element_at(F.array(*map(F.lit, MONTHS)), number.cast("int"))


def date_string(day: Column, month: Column, year: Column) -> Column:
    """'14 January 2008' from its parts; missing parts are left out."""
    return F.concat_ws(" ", day.cast("string"), F.when(month.isNotNull(), month_name(month)), year.cast("string"))


def iso_date_string(col: Column) -> Column:
    """'2008-01-14' as '14 January 2008' and '2008-01' as 'January 2008'; null for anything else."""
    ok = col.rlike("^\\d{4}-\\d\\d(-\\d\\d)?$")
    p = F.split(col, "-")
    return F.when(ok, F.concat_ws(" ", F.regexp_replace(F.try_element_at(p, F.lit(3)), "^0", ""), month_name(F.try_element_at(p, F.lit(2)).try_cast("int")), p[0]))


def entity_class(category: Column) -> Column:
    """'person', 'nonperson' or null by the words of a category (fixed words and exceptions)."""
    c = F.lower(category)
    has = lambda w: c.contains(w)
    inside = lambda w: F.instr(c, w) > 1
    nonperson = (
        inside(" agencies") | has("companies") | has("organization") | has("ministries") | has("software") | has(" music groups") | has("schools") | has("colleges") | has("visitor attractions") | has("museums") | has("charities")
        | (inside(" established") & ~has("states ") & ~has("places ") & ~has("settlements")) | (has("universit") & ~has("academics") & ~has("faculty") & ~has("alumni"))
    )
    return F.when(has("living people"), "person").when(nonperson, "nonperson")


def choose_snippet(a: Column, b: Column) -> Column:
    """The shorter of two snippets; the second of two as long."""
    return F.when(a.isNull(), b).when(b.isNull(), a).when(F.length(a) < F.length(b), a).otherwise(b)


def memory_size(col: Column) -> Column:
    """'8G' or '100M' as bytes; plain numbers as they are, null for anything else."""
    n = F.regexp_extract(col, "^(\\d+)([kKmMgG]?)[bB]?$", 1)
    unit = F.lower(F.regexp_extract(col, "^(\\d+)([kKmMgG]?)[bB]?$", 2))
    return F.when(n != "", n.try_cast("long") * F.when(unit == "k", 1 << 10).when(unit == "m", 1 << 20).when(unit == "g", 1 << 30).otherwise(1))


def bracketize(text: Column, key: Column) -> Column:
    """The first place of ``key`` in a text, whatever its case and at word bounds, as [[key|as written]]; null when there is none."""
    quoted = F.regexp_replace(F.lower(key), "([\\\\.\\[\\]{}()*+?^$|/-])", "\\\\$1")
    at = F.regexp_instr(F.lower(text), F.concat(F.lit("(?:(?<=^)|(?<= ))"), quoted, F.lit("(?=[,.'\\s]|$)")))
    n = F.length(key)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit("[["), key, F.lit("|"), F.substring(text, at, n), F.lit("]]"), F.substring(text, at + n, F.lit(10**6))))


def composite_key(hi: Column, lo: Column) -> Column:
    """Two unsigned 32-bit ids packed into one long."""
    return F.shiftleft(hi.cast("long"), 32).bitwiseOR(lo.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))


def decompose_key(key: Column) -> tuple[Column, Column]:
    """The two ids of a packed key."""
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(0xFFFFFFFF))
