"""Names, brands, tokens, asset names and labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases and the size pattern that product names are cleaned of.
CONCENTRATION_PHRASES = ("eau de parfum", "eau de cologne", "eau de toilette")
SIZE_PATTERN = r"\b\d+(?:ml|g)\b"

# Letters without a canonical decomposition and their ASCII spelling.
LIGATURES = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
}
PLAIN_LETTERS = {
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L",
    "ħ": "h", "Ħ": "H", "ı": "i", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-",
}


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from Unicode decompositions."""
    accented, plain = list(PLAIN_LETTERS), list(PLAIN_LETTERS.values())
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def clean_product_name(name: Column, drop_sizes: bool = False) -> Column:
    """Lower-case a name and delete concentration phrases, and sizes if asked."""
    cleaned = F.lower(name)
    for phrase in CONCENTRATION_PHRASES:
        cleaned = F.replace(cleaned, F.lit(phrase), F.lit(""))
    if drop_sizes:
        cleaned = F.regexp_replace(cleaned, SIZE_PATTERN, "")
    return cleaned


def token_set(text: Column) -> Column:
    """Distinct non-empty pieces of ``text`` between single spaces."""
    return F.array_distinct(F.filter(F.split(text, " "), lambda token: token != ""))


def jaccard_similarity(left: Column, right: Column) -> Column:
    """Shared over total tokens of two sets, 0 when either is empty or null."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(F.array_union(left, right))
    filled = (F.size(left) > 0) & (F.size(right) > 0)
    return F.when(filled, shared / total).otherwise(F.lit(0.0))


def brand_key(brand: Column) -> Column:
    """Upper-case comparison key; a missing brand is the blank brand."""
    return F.upper(F.coalesce(brand, F.lit("")))


def fold_accents(text: Column) -> Column:
    """ASCII, lower-case spelling of Latin text, used to join brand names."""
    folded = F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"[\u0300-\u036f]", "")
    for letter, spelling in LIGATURES.items():
        folded = F.replace(folded, F.lit(letter), F.lit(spelling))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.lower(F.when(ascii_only, text).otherwise(folded))


def asset_name(name: Column, url: Column) -> Column:
    """File name of a product's picture: cleaned name, ``__``, id segment of the URL."""
    segment = F.try_element_at(F.split(url, r"\."), F.lit(-2))
    return F.concat(F.translate(name, " /", "__"), F.lit("__"), segment, F.lit(".jpg"))


# Fixed value: how the pictures of internal products are named.
ASSET_SUFFIX = "_in_xl.jpg"


def asset_of_id(product_id: Column) -> Column:
    """Picture name under which an internal product's vector is stored."""
    return F.concat(product_id, F.lit(ASSET_SUFFIX))


def id_of_asset(asset: Column) -> Column:
    """Product id in a picture name: what stands before the suffix, whatever its length."""
    return F.when(
        F.endswith(asset, F.lit(ASSET_SUFFIX)),
        F.left(asset, F.length(asset) - len(ASSET_SUFFIX)),
    ).otherwise(asset)


def padded_code(number: Column, width: int = 6) -> Column:
    """A number as a code of at least ``width`` digits; longer ones are not cut."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def asset_path(product_id: Column, root: str, pos: str = "in", size: str = "xl") -> Column:
    """Folder path of a product's picture: one folder per leading character of its id."""
    folders = [F.substring(product_id, position, 1) for position in (1, 2, 3)]
    file_name = F.concat(product_id, F.lit(f"_{pos}_{size}.jpg"))
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit(size), *folders, file_name)


def detail_text(fields: Sequence[tuple[str, Column]]) -> Column:
    """``Title: value`` lines; array values are shown as a comma list."""
    lines = [F.concat(F.lit(f"{title}: "), F.coalesce(value, F.lit(""))) for title, value in fields]
    return F.concat_ws("\n", *lines)


def cluster_label(*parts: Column) -> Column:
    """Segment name from its parts, null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), part] if pieces else [part]
    return F.concat(*pieces)


def cluster_relabel(label: Column, keep: Sequence[int] = (0, 1, 3)) -> Column:
    """Keep the given parts of an underscore label; by default the note group goes."""
    parts = F.split(label, "_")
    return F.concat_ws("_", *[F.try_element_at(parts, F.lit(index + 1)) for index in keep])


def sanitize_label(label: Column, variant: str = "spaces") -> Column:
    """A label as a column-name fragment, as data. See :func:`sanitize_name`."""
    if variant == "words":
        return F.translate(F.translate(label, "()", ""), "- ", "__")
    if variant == "spaces":
        return F.translate(label, " ", "_")
    if variant == "compact":
        return F.translate(F.translate(label, "-()", ""), " ", "_")
    raise ValueError(f"unknown variant {variant!r}")


def sanitize_name(label: str, variant: str = "spaces") -> str:
    """A label as a column-name fragment.

    ``words`` drops parentheses and turns hyphens and spaces into underscores,
    ``spaces`` turns spaces into underscores, ``compact`` drops hyphens and
    parentheses and turns spaces into underscores.
    """
    if variant not in {"words", "spaces", "compact"}:
        raise ValueError(f"unknown variant {variant!r}")
    dropped = {"words": "()", "spaces": "", "compact": "-()"}[variant]
    underscored = "- " if variant == "words" else " "
    table = {ord(char): "" for char in dropped} | {ord(char): "_" for char in underscored}
    return label.translate(table)
