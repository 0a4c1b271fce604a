"""Text rules as Catalyst expressions: titles, person names, venues, identifiers (TX*, PRJ*)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Title prefixes that are dropped.
TITLE_PREFIXES = [
    "Association for Computational Linguistics.",
    "Explorer",
    "Erratum to",
    "UvA-DARE ( Digital Academic Repository )",
    "Invited Talk:",
    "Combination of",
    "40 80 11 v 1 2 2 A ug 1 99 4",
    "Edinburgh Research Explorer",
    "Toward",
]
#: Tokens that are no part of a person's name.
NAME_TITLES = ["jr", "sr", "phd", "md", "iii", "ii", "iv", "v", "esq", "dr", "prof", "professor"]
#: Words that begin a venue's long form, tested once each in this order.
VENUE_PREFIXES = ["proceedings of", "proc.", "conference on", "symposium on", "international"]
#: Words that show a conference.
VENUE_CONTEXT = ["proceedings", "conference", "symposium", "workshop", "acm", "ieee", "international", "proc.", "proc "]
#: Letters that decomposition leaves alone or that a table must map: accented Latin to ASCII.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēėęěğīįıłńňōőřśşšťūůűźżžÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝĀĂĄĆČĎĐĒĖĘĚĞĪĮİŁŃŇŌŐŘŚŞŠŤŪŮŰŹŻŽ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeeegiiilnnoorssstuuuzzzAAAAAACEEEEIIIINOOOOOOUUUUYAAACCDDEEEEGIIILNNOORSSSTUUUZZZ"
assert len(ACCENTED) == len(PLAIN)
#: Letters that become two.
DOUBLED = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D"}


def quote(text: str) -> str:
    """``text`` as a literal in a Java regular expression."""
    return "".join(c if c.isalnum() or c == " " or ord(c) > 127 else "\\" + c for c in text)


def title_key(title: Column) -> Column:
    """Null as empty; without a known prefix, without what stands before a colon; only a-z and 0-9 (TX1)."""
    prefixes = "|".join(quote(p) for p in sorted(TITLE_PREFIXES, key=len, reverse=True))
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^\s+", "")
    t = F.regexp_replace(t, f"(?iu)^(?:{prefixes})", "")
    for colon in (":", "："):
        t = F.element_at(F.split(t, colon, 2), -1)
    return F.regexp_replace(F.lower(t), "[^a-z0-9]+", "")


def transliterate(text: Column) -> Column:
    """Latin letters with marks to ASCII; other scripts stay as they are."""
    for letter, pair in DOUBLED.items():
        text = F.replace(text, F.lit(letter), F.lit(pair))
    return F.translate(text, ACCENTED, PLAIN)


def _is_plain(name: Column) -> Column:
    """Words of ASCII letters, digits and dots between single spaces, no title among them, no short number at the end."""
    titles = "|".join(sorted(NAME_TITLES))
    return name.rlike(rf"^(?!.* [0-9]{{1,4}}\z)(?!(?:.* )?(?i:{titles})(?: |\z))[A-Za-z0-9.]+(?: [A-Za-z0-9.]+)*\z")


def person_name(name: Column) -> Column:
    """A name for comparing: first name first, no numbers or titles at the end, ASCII, lower case (TX3)."""
    return F.when(_is_plain(name), F.lower(name)).otherwise(_any_person_name(name))


def _any_person_name(name: Column) -> Column:
    """``person_name`` step by step, for any text."""
    swapped = F.when(
        F.instr(name, ",") > 0,
        F.concat(F.trim(F.regexp_replace(name, r"(?s)^[^,]*,", "")), F.lit(" "), F.trim(F.substring_index(name, ",", 1))),
    ).otherwise(name)
    n = F.regexp_replace(F.regexp_replace(swapped, r"(?U)\s+\d{4}$", ""), r"(?U)\s+\d{1,3}$", "")
    n = F.lower(transliterate(n))
    tokens = F.filter(F.split(F.trim(F.regexp_replace(n, r"(?U)\s+", " ")), " "), lambda x: ~x.isin(NAME_TITLES))
    n = F.translate(F.array_join(tokens, " "), "-_", "  ")
    n = F.regexp_replace(n, r"(?U)[^\w\s.]", "")
    return F.coalesce(F.trim(F.regexp_replace(n, r"(?U)\s+", " ")), F.lit(""))


def initials_key(normalised: Column) -> Column:
    """Initials of all tokens but the last, and the last; null for fewer than two tokens (TX6)."""
    tokens = F.filter(F.split(normalised, " "), lambda x: x != "")
    initials = F.array_join(F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(1))), lambda x: F.left(x, F.lit(1))), "")
    return F.when(F.size(tokens) >= 2, F.concat(initials, F.lit(" "), F.element_at(tokens, -1)))


def name_readings(normalised: Column) -> Column:
    """Array of (initial, surname): both orders of two tokens, the last of more, none of one (TX4)."""
    t = F.filter(F.split(normalised, " "), lambda x: x != "")

    def pair(initial: Column, surname: Column) -> Column:
        return F.struct(initial.alias("initial"), surname.alias("surname"))

    first, last = F.get(t, F.lit(0)), F.get(t, F.size(t) - 1)
    return (
        F.when(F.size(t) >= 3, F.array(pair(F.left(first, F.lit(1)), last)))
        .when(F.size(t) == 2, F.array(pair(F.left(first, F.lit(1)), last), pair(F.left(last, F.lit(1)), first)))
        .when(F.size(t) == 1, F.array(pair(F.lit(""), first)))
        .otherwise(F.array().cast("array<struct<initial:string,surname:string>>"))
    )


def abbreviates(a: Column, b: Column) -> Column:
    """Whether two names are equal token by token, single letters standing for words (TX5)."""
    x, y = F.split(a, " "), F.split(b, " ")

    def same(p: Column) -> Column:
        u, v = F.rtrim(p["x"], F.lit(".")), F.rtrim(p["y"], F.lit("."))
        short = (F.length(u) == 1) | (F.length(v) == 1)
        return F.when(short, F.left(u, F.lit(1)) == F.left(v, F.lit(1))).otherwise(u == v)

    return (F.size(x) == F.size(y)) & F.forall(F.arrays_zip(x.alias("x"), y.alias("y")), same)


def venue_normal(venue: Column) -> Column:
    """Lower case without the usual beginnings, each tested once in order (TX7)."""
    v = F.trim(F.lower(F.coalesce(venue, F.lit(""))))
    for prefix in VENUE_PREFIXES:
        v = F.when(F.startswith(v, F.lit(prefix)), F.trim(F.substr(v, F.lit(len(prefix) + 1)))).otherwise(v)
    return v


def quoted(pattern: Column) -> Column:
    """A column of literal text for use inside a regular expression."""
    return F.regexp_replace(pattern, r"([^\p{L}\p{N} ])", r"\\$1")


def whole_word(text: Column, pattern: Column) -> Column:
    """The pattern stands between word boundaries (TX8); both in lower case."""
    return F.regexp_like(text, F.concat(F.lit(r"(?U)\b"), quoted(pattern), F.lit(r"\b")))


def has_context(venue: Column) -> Column:
    """Any word that shows a conference (TX9)."""
    low, out = F.lower(venue), F.lit(False)
    for word in VENUE_CONTEXT:
        out = out | F.contains(low, F.lit(word))
    return out


def has_year(text: Column, code: Column) -> Column:
    """The code with a year: ``EC 2024``, ``EC'23``, ``EC-2024`` (TX10); both in lower case."""
    code = F.concat(F.lit(r"(?U)\b"), quoted(code))
    forms = [r"\s+[12]\d{3}\b", r"\s*['`]\s*\d{2}\b", r"\s*-\s*[12]\d{3}\b"]
    return F.regexp_like(text, F.concat(code, F.lit(f"(?:{'|'.join(forms)})")))


def is_short(code: Column) -> Column:
    """Codes of three characters or fewer need a word boundary and context (TX11)."""
    return F.length(code) <= 3


def like_pattern(title: Column) -> Column:
    """``%w1%w2%w3%`` of the first three words longer than three characters; null without one (TX14)."""
    words = F.slice(F.filter(F.split(F.lower(title), " "), lambda w: F.length(w) > 3), 1, 3)
    escaped = F.transform(words, lambda w: F.regexp_replace(w, r"([%_\\])", r"\\$1"))
    return F.when(F.size(words) > 0, F.concat(F.lit("%"), F.array_join(escaped, "%"), F.lit("%")))


def clean_text(text: Column) -> Column:
    """No line breaks, no space around (PRJ12)."""
    return F.translate(F.trim(text), "\n\r", " ")


def doi_of(link: Column) -> Column:
    """The last two segments of a doi.org link in lower case; longer DOIs lose their front (PRJ13)."""
    low = F.lower(link)
    parts = F.split(low, "/")
    tail = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "/")
    return F.when(F.contains(low, F.lit("doi.org")) & (F.size(parts) >= 2), tail)


def venue_of_key(key: Column) -> Column:
    """Second segment of a bibliography key in lower case (PRJ14)."""
    return F.lower(F.get(F.split(key, "/"), F.lit(1)))


def paper_id_of(url: Column, direct: Column | None = None) -> Column:
    """A given id, else the 40 hex digits after ``/paper/`` (PRJ2)."""
    found = F.nullif(F.regexp_extract(url, r"/paper/([a-f0-9]{40})", 1), F.lit(""))
    return found if direct is None else F.coalesce(F.nullif(direct, F.lit("")), found)


def true_text(value: Column) -> Column:
    """Text as a boolean: only ``true`` in any case (PRJ3)."""
    return F.coalesce(F.lower(value.cast("string")) == "true", F.lit(False))


def pdf_url(raw: Column) -> Column:
    """``url`` of an object, or the text itself (PRJ4); ``raw`` is JSON text."""
    return F.when(F.startswith(F.trim(raw), F.lit("{")), F.get_json_object(raw, "$.url")).otherwise(F.nullif(F.trim(raw, F.lit('"')), F.lit("")))


def first_filled(*arrays: Column) -> Column:
    """The first array that is not null and not empty, else an empty one (PRJ5)."""
    out = F.coalesce(*[F.when(F.size(a) > 0, a) for a in arrays])
    return F.coalesce(out, F.array().cast("array<string>"))


def author_field(raw: Column) -> Column:
    """Names of a JSON list, else of text cut at ``;``, else at ``|`` (PRJ9)."""
    listed = F.from_json(raw, "array<string>")
    cut = F.when(F.contains(raw, F.lit(";")), F.split(raw, ";")).otherwise(F.split(raw, r"\|"))
    names = F.coalesce(F.when(F.startswith(F.trim(raw), F.lit("[")), listed), cut)
    return F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "")


def embedding_text(code: Column, full: Column, aliases: Column) -> Column:
    """``code | full name | alias ...`` without what is missing (TX15)."""
    return F.concat_ws(" | ", code, F.nullif(full, F.lit("")), aliases)
