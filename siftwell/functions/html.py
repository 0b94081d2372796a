"""Page text, markdown, title, images and links from raw HTML, by built-in string functions."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import let

# Markup patterns and the character references that are decoded.
HIDDEN = (
    "(?is)<script[^>]*>.*?</script>",
    "(?is)<style[^>]*>.*?</style>",
    "(?s)<!--.*?-->",
)
TAG = "(?s)<[^>]*>"
TITLE = "(?is)<title[^>]*>(.*?)</title>"
# A tag of some name; a quoted value may hold the character that ends a tag.
WHOLE_TAG = "(?is)<{}(?=[\\s/>])(?:=\\s*\"[^\"]*\"|=\\s*'[^']*'|[^>])*?>"
# An attribute: its name, and its value in double quotes, in single quotes, or bare.
ATTRIBUTE = "(?s)([^\\s\"'>/=]+)(?:\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>][^\\s>]*)))?"
REFERENCE = "&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
ENTITIES = (
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
)
MARKDOWN = (
    ("(?is)<title[^>]*>.*?</title>", ""),
    ("(?is)<h1[^>]*>(.*?)</h1>", "\n# $1\n"),
    ("(?is)<h2[^>]*>(.*?)</h2>", "\n## $1\n"),
    ("(?is)<h3[^>]*>(.*?)</h3>", "\n### $1\n"),
    ('(?is)<a\\s[^>]*href\\s*=\\s*"([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)"),
    ("(?is)<a\\s[^>]*href\\s*=\\s*'([^']*)'[^>]*>(.*?)</a>", "[$2]($1)"),
    ("(?is)<a\\s[^>]*href\\s*=\\s*([^\\s\"'>]+)[^>]*>(.*?)</a>", "[$2]($1)"),
    ("(?i)<li[^>]*>", "\n- "),
    ("(?i)</?(?:b|strong)>", "**"),
    ("(?i)<(?:br|p|div|article|section|ul|ol|nav|footer)(?:\\s[^>]*)?/?>", "\n"),
)


def _drop_hidden(html: Column) -> Column:
    for pattern in HIDDEN:
        html = F.regexp_replace(html, pattern, " ")
    return html


def _code_point(body: Column) -> Column:
    """Code point of a reference between '&' and ';'; null for a name that is not known."""
    number = F.when(F.lower(body).startswith("#x"), F.conv(F.substring(body, 3, 100), 16, 10)).otherwise(F.substring(body, 2, 100))
    names = F.from_json(F.lit(json.dumps(name2codepoint)), "map<string, bigint>")
    # A number that is too large stands for no character.
    return F.when(body.startswith("#"), F.coalesce(number.try_cast("long"), F.lit(-1))).otherwise(F.try_element_at(names, body))


def _character(code: Column) -> Column:
    sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    point = F.when(sound, code).otherwise(F.lit(0xFFFD).cast("long"))
    return F.when(code.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))


def _decoded(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    pairs = F.transform(
        found,
        lambda r: F.struct(r.alias("reference"), let(_code_point(F.substring_index(F.substring(r, 2, 100), ";", 1)), _character).alias("character")),
    )
    known = F.filter(pairs, lambda p: p["character"].isNotNull())
    # False sorts first.
    ordered = F.array_sort(F.transform(known, lambda p: F.struct((p["character"] == "&").alias("last"), p["reference"], p["character"])))
    return F.aggregate(ordered, text, lambda done, p: F.replace(done, p["reference"], p["character"]))


def decode_references(text: Column) -> Column:
    """Numeric references of any character and the named ones of HTML 4; names that are not known stay.

    What stands for '&' is replaced last, so nothing is decoded twice.
    """
    for reference, character in ENTITIES[:-1]:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return let(text, lambda plain: F.when(F.contains(plain, F.lit("&")), _decoded(plain)).otherwise(plain))


def attribute(tag: Column, name: str) -> Column:
    """The decoded value of an attribute of a tag, however it is quoted; null where there is none."""
    each = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    own = F.filter(each, lambda a: F.contains(a, F.lit("=")) & (F.lower(F.regexp_extract(a, ATTRIBUTE, 1)) == name))
    value = let(F.get(own, F.lit(0)), lambda a: F.concat(*[F.regexp_extract(a, ATTRIBUTE, k) for k in (2, 3, 4)]))
    return decode_references(value)


def attributes(html: Column, tag: str, name: str) -> Column:
    """The values of an attribute in all tags of a name, in order; comments and scripts are not searched."""
    # The name of the tag is no attribute.
    tags = F.regexp_extract_all(_drop_hidden(html), F.lit(WHOLE_TAG.format(tag)), F.lit(0))
    values = F.transform(tags, lambda t: attribute(F.substring(t, len(tag) + 2, 1 << 20), name))
    return F.filter(values, lambda v: v.isNotNull())


def html_base(html: Column) -> Column:
    """What links of the page are relative to, if it says so."""
    return F.get(attributes(html, "base", "href"), F.lit(0))


def html_text(html: Column) -> Column:
    """Visible text on one line."""
    bare = F.regexp_replace(_drop_hidden(html), TAG, " ")
    return F.trim(F.regexp_replace(decode_references(bare), "[ \\t\\r\\n]+", " "))


def html_markdown(html: Column) -> Column:
    """Headings, list items, links and bold as markdown; one line break between blocks."""
    text = _drop_hidden(html)
    for pattern, replacement in MARKDOWN:
        text = F.regexp_replace(text, pattern, replacement)
    text = decode_references(F.regexp_replace(text, TAG, ""))
    text = F.regexp_replace(text, "[ \\t\\r]+", " ")
    return F.regexp_replace(F.regexp_replace(text, " ?\\n[ \\n]*", "\n"), "^\\n+|\\n+$", "")


def html_title(html: Column) -> Column:
    return decode_references(F.trim(F.regexp_extract(html, TITLE, 1)))


def html_links(html: Column) -> Column:
    return attributes(html, "a", "href")


def html_images(html: Column) -> Column:
    return attributes(html, "img", "src")


def html_extract(html: Column, format: str = "text") -> Column:
    """Struct of title, content ('text' or 'markdown'), images and links."""
    if format not in ("text", "markdown"):
        raise ValueError("format must be 'text' or 'markdown'.")
    body = html_text(html) if format == "text" else html_markdown(html)
    return F.struct(
        html_title(html).alias("title"),
        body.alias("content"),
        html_images(html).alias("images"),
        html_links(html).alias("links"),
    )
