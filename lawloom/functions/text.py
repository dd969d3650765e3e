"""Text cleaning as Column expressions; every function takes and returns a Column."""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.trim(c, F.lit(C.WS_CHARS))


def collapse(c: Column) -> Column:
    """White-space runs to one blank, trimmed; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), C.WS_RUN, " "))


def clean_line(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\u3000"), F.lit(" ")))


def _split_lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, C.LINE_BREAK, "\n"), "\n")


def lines_of(text: Column) -> Column:
    """Array of trimmed, non-blank lines."""
    return F.filter(F.transform(_split_lines(F.coalesce(text, F.lit(""))), clean_line), lambda l: l != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def file_name(c: Column) -> Column:
    """Drop characters that file names may not hold; a default when nothing is left."""
    cleaned = strip(F.translate(c, C.ILLEGAL_FILE_CHARS, ""))
    return F.coalesce(blank_to_null(cleaned), F.lit(C.DEFAULT_LAW_NAME))


def short_document_name(c: Column) -> Column:
    no_parens = F.regexp_replace(c, r"\(.*?\)", "")
    return F.substring(F.replace(no_parens, F.lit(" "), F.lit("_")), 1, 50)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)


def form_encoded(c: Column) -> Column:
    """Form encoding: blank as '+', only letters, digits and `_.-~` kept."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def path_encoded(c: Column) -> Column:
    """Path encoding: blank as '%20', '/' kept."""
    return F.replace(F.replace(form_encoded(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def search_url(base: str, name: Column) -> Column:
    return F.concat(F.lit(base), form_encoded(name))


def law_detail_url(name: Column, base: str = C.LAW_DETAIL_BASE) -> Column:
    return F.concat(F.lit(base), path_encoded(name))


def list_detail_url(item_id: Column, base: str = C.LIST_BASE, path: str = C.LIST_DETAIL_PATH) -> Column:
    """NULL id gives NULL."""
    return F.concat(F.lit(base + path + "?bdSeq="), blank_to_null(item_id))


def iso_date(c: Column) -> Column:
    """Eight digits to yyyy-MM-dd; anything else unchanged."""
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"^(\p{Nd}{4})(\p{Nd}{2})(\p{Nd}{2})\z", "$1-$2-$3")


def letters_spaced(c: Column) -> Column:
    """Keep digits, Latin, Hangul and jamo; every other run becomes one blank."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    other = C.NOT_LETTER
    return F.trim(F.regexp_replace(text, f"{other}(?:(?<=[^ ]){other}*+|{other}++)", " "))


def letters_only(c: Column) -> Column:
    """Keep Hangul syllables, Latin, digits and blanks; everything else is deleted."""
    spaced = F.regexp_replace(F.coalesce(c, F.lit("")), C.WS_RUN, " ")
    kept = F.regexp_replace(spaced, "[^가-힣A-Za-z0-9 ]+", "")
    return F.trim(F.regexp_replace(kept, " {2,}", " "))


def kept_letters(c: Column) -> Column:
    """Digits, Latin, Hangul and jamo; everything else deleted."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), f"{C.NOT_LETTER}++", "")


def compare_key(c: Column) -> Column:
    """The kept letters in lower case, which has as many."""
    return F.lower(kept_letters(c))


def drop_law_tags(c: Column) -> Column:
    """Most texts have no tag and are only searched for '<'."""

    def dropped(text):
        no_tags = F.regexp_replace(text, "(?i)</?LAW[^>]*>", "")
        return F.regexp_replace(no_tags, rf"(?i)<{C.WS}*LAW[_A-Za-z0-9\-]*{C.WS}*>", "")

    return bind(c, lambda t: F.when(F.contains(t, F.lit("<")), dropped(t)).otherwise(t))


def clean_cell(c: Column) -> Column:
    """Cell cleaning for text columns; NULL stays NULL."""
    t = F.regexp_replace(c, C.ZERO_WIDTH, "")
    t = F.translate(t, C.GLYPHS, "")
    t = F.regexp_replace(t, r"(?dm)^[\-=_]{2,}$", "")
    t = F.regexp_replace(t, "(?i)</?LAW[^>]*>", "")
    t = F.regexp_replace(t, "[ \t]{2,}", " ")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def keep_law_lines(c: Column, keep_decimals: bool = False) -> Column:
    """Multi-line cleaning that strips leading bullets except on article lines.

    The bullet group is possessive, so a line of many bullets needs no regex recursion.
    """
    bullets = C.LEADING_BULLETS_KEEP_DECIMALS if keep_decimals else C.LEADING_BULLETS
    t = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("\n")), F.lit("\u00a0"), F.lit(" "))
    t = bind(strip(t), lambda s: F.when(F.contains(s, F.lit("\n\n\n")), F.regexp_replace(s, "\n{3,}", "\n\n")).otherwise(s))
    t = F.array_join(F.transform(_split_lines(t), strip), "\n")
    wide = lambda s: F.contains(s, F.lit("  ")) | F.contains(s, F.lit("\t"))
    t = drop_law_tags(bind(t, lambda s: F.when(wide(s), F.regexp_replace(s, "[ \t]{2,}", " ")).otherwise(s)))
    return strip(
        F.array_join(
            F.transform(
                F.split(t, "\n"),
                lambda l: F.when(l.rlike(rf"^{C.WS}*제{C.WS}*\p{{Nd}}+{C.WS}*조"), strip(l)).otherwise(
                    strip(F.regexp_replace(l, rf"^{bullets}++", ""))
                ),
            ),
            "\n",
        )
    )


def drop_leading_index(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), C.LEADING_INDEX, "")


def first_sentence(c: Column, limit: int = C.SENTENCE_LIMIT) -> Column:
    head = F.regexp_extract(collapse(c), "^(.+?)(?:[.!?。…]|$)", 1)
    return strip(F.substring(head, 1, limit))


def round_title(c: Column) -> Column:
    return F.regexp_replace(collapse(c), C.ROUND_PREFIX, "")


def trial_title(c: Column) -> Column:
    return bind(collapse(c), lambda full: F.coalesce(blank_to_null(F.regexp_replace(full, C.TRIAL_PREFIX, "")), full))


def drop_prefix(c: Column, pattern: str) -> Column:
    return strip(F.regexp_replace(c, "(?i)" + pattern, ""))


def strip_separators(c: Column) -> Column:
    return F.trim(c, F.lit(C.SEPARATOR_CHARS))


def remove_once(c: Column, part: Column) -> Column:
    """Delete the first occurrence of `part`."""

    def cut(z):
        at = F.position(z.part, z.text)
        return F.when(
            (z.part != "") & (at > 0),
            F.concat(F.substr(z.text, F.lit(1), at - 1), F.substr(z.text, at + F.length(z.part))),
        ).otherwise(z.text)

    return bind(F.struct(c.alias("text"), part.alias("part")), cut)


#: Characters that markup itself uses keep their entity until `unescape`.
_KEPT = {60: "&lt;", 62: "&gt;", 34: "&quot;", 39: "&#39;", 38: "&amp;", 160: "&nbsp;"}


def decode_entities(c: Column) -> Column:
    """Named and numeric character entities to characters, but for the six that `unescape` takes last; unknown ones stay."""
    pairs = [f"{name}\x01{chr(code)}" for name, code in sorted(name2codepoint.items()) if code not in _KEPT]
    names = F.str_to_map(F.lit("\x02".join(pairs)), F.lit("\x02"), F.lit("\x01"))

    def fixed(part):
        return bind(F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});", 1), lambda name: of_name(part, name))

    def of_name(part, name):
        hexadecimal = F.conv(F.substring(name, 3, 6), 16, 10)
        number = F.when(name.rlike("^#[xX]"), hexadecimal).when(F.startswith(name, F.lit("#")), F.substring(name, 2, 7)).try_cast("bigint")
        return bind(number, lambda n: with_char(part, name, n))

    def with_char(part, name, n):
        kept = F.lit(None).cast("string")
        for code, entity in _KEPT.items():
            kept = F.when(n == code, entity).otherwise(kept)
        legal = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        char = F.coalesce(kept, F.when(legal, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")), F.try_element_at(names, name))
        return bind(char, lambda ch: F.when(ch.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(ch, F.substr(part, F.length(name) + 2))))

    def of_parts(parts):
        return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(fixed(p))), "")

    odd = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)#?[A-Za-z0-9]+;"
    return F.when(F.contains(c, F.lit("&")) & c.rlike(odd), bind(F.split(c, "&"), of_parts)).otherwise(c)


def unescape(c: Column) -> Column:
    """The six entities that `decode_entities` leaves; '&amp;' last. Most texts have none and are only searched for '&'."""

    def replaced(text):
        for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]:
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    return bind(c, lambda t: F.when(F.contains(t, F.lit("&")), replaced(t)).otherwise(t))


def null_word_to_blank(c: Column) -> Column:
    return bind(
        strip(F.coalesce(c, F.lit(""))),
        lambda v: F.when(v.isin(C.NULL_WORDS) | v.rlike(C.NULL_WORD_PATTERN), F.lit("")).otherwise(v),
    )


def any_of(words) -> str:
    """Pattern of an alternation of words, not empty; characters that none of them begins with are mostly passed over by one comparison."""
    first = sorted(w[0] for w in words)
    return rf"(?=[{first[0]}-{first[-1]}])(?:{'|'.join(words)})"


def is_noise(c: Column) -> Column:
    return bind(F.coalesce(c, F.lit("")), lambda t: ~t.rlike(C.NOT_WS) | t.rlike(any_of(C.NOISE_TOKENS)))


def signature(texts: Column, n: int = 5) -> Column:
    """First n entries, trimmed and joined: a fingerprint of a list page."""
    return F.array_join(F.transform(F.slice(texts, 1, n), strip), "|")


def joined_cells(cells: Column) -> Column:
    return F.array_join(cells, " | ")
