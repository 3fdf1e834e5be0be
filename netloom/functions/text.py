"""Column expressions for names, references and identifier lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Term prefixes whose first dash-separated part is a species or class tag.
TAGGED_TERMS = ("hsa", "lnc")
# One parenthesised group, with groups inside it.
GROUP = r"\((?:[^()]|\([^()]*\))*\)"


def normalize_term(term: Column) -> Column:
    """Name reduced to word characters and ``+``, for matching across vocabularies.

    The tag of a tagged term ("hsa-miR-1") is dropped when it is followed by a dash. Case is kept.
    """
    tagged = term.contains(TAGGED_TERMS[0]) | term.contains(TAGGED_TERMS[1])
    untagged = F.when(tagged & term.contains("-"), F.regexp_replace(term, "^[^-]*-", "")).otherwise(term)
    return F.regexp_replace(untagged, r"[^\w+]+", "")


def matching_key(term: Column) -> Column:
    """Normalised lower-case term; null instead of an empty key, so it never joins."""
    return F.nullif(F.lower(normalize_term(term)), F.lit(""))


def clean_reference(reference: Column) -> Column:
    """``db:rest`` without its database prefix, ``=`` written as ``:``; empty when there is no prefix."""
    rest = F.when(reference.contains(":"), F.regexp_replace(reference, "^[^:]*:", "")).otherwise(F.lit(""))
    return F.replace(rest, F.lit("="), F.lit(":"))


def pad_disease_id(number: Column) -> Column:
    """``C`` and the number zero-padded to seven digits; longer numbers are left whole."""
    return F.concat(F.lit("C"), F.when(F.length(number) < 7, F.lpad(number, 7, "0")).otherwise(number))


def accession_list(reference: Column) -> Column:
    """``DB:a;b [note];`` to ``[DB:a, DB:b]``; numbers of a disease database are padded.

    A value may itself hold ``:``; only the first one separates the prefix.
    """
    prefix = F.substring_index(reference, ":", 1)
    body = F.when(reference.contains(":"), F.regexp_replace(reference, "^[^:]*:", "")).otherwise(F.lit(""))
    items = F.filter(F.split(body, ";"), lambda x: x != "")
    padded = F.transform(items, lambda x: F.concat(prefix, F.lit(":"), pad_disease_id(x)))
    plain = F.transform(items, lambda x: F.concat(prefix, F.lit(":"), F.substring_index(x, " [", 1)))
    return F.when(F.lower(prefix).contains("disge"), padded).otherwise(plain)


def expand_family(name: Column) -> Column:
    """``miR-1/206`` to ``[miR-1, miR-206]``; only the first dash separates the family prefix."""
    parts = F.split(name, "-", 2)
    prefix, rest = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    expanded = F.transform(F.split(rest, "/"), lambda x: F.concat(prefix, F.lit("-"), x))
    return F.when(name.contains("-"), expanded).otherwise(F.array(name))


def human_mirna_reference(reference: Column) -> Column:
    """``miRNA:miR-1`` to ``miRNA:hsa-mir-1``; any other reference is unchanged."""
    prefix = F.substring_index(reference, ":", 1)
    value = F.regexp_replace(reference, "^[^:]*:", "")
    applies = reference.contains(":") & prefix.contains("miRNA")
    return F.when(applies, F.concat(prefix, F.lit(":hsa-"), F.lower(value))).otherwise(reference)


def inverted_names(name: Column) -> Column:
    """``X, Y`` to ``[Y X, X, Y]``: the natural word order first, then the name itself.

    A last part with a digit ("..., type 2") stays last; names containing "and" are not inverted.
    """
    parts = F.split(name, ", ")
    last = F.element_at(parts, -1)
    front = F.reverse(F.slice(parts, 1, F.size(parts) - 1))
    numbered = F.concat(F.array_join(front, " "), F.lit(" "), last)
    natural = F.when(last.rlike("[0-9]"), numbered).otherwise(F.array_join(F.reverse(parts), " "))
    skip = F.lower(name).contains("and") | (F.size(parts) < 2)
    return F.when(skip, F.array(name)).otherwise(F.array(natural, name))


def protein_aliases(names: Column) -> Column:
    """Leading protein name, then every alternative of the groups that end the text, whole.

    ``Name (EC 1.1) (Other) [Cleaved into: ...]``: what stands in brackets at the end belongs to other proteins. A group inside the
    leading name stays part of it.
    """
    own = F.regexp_replace(names, r"\s*\[.*$", "")
    leading = F.regexp_extract(own, rf"^(.*?)(?:\s+{GROUP})*$", 1)
    groups = F.regexp_extract_all(F.substring(own, F.length(leading) + 1, F.length(own)), F.lit(rf"\s({GROUP})"), F.lit(1))
    return F.concat(F.array(leading), F.transform(groups, lambda g: F.substring(g, F.lit(2), F.length(g) - 2)))


def proteins_of_species(lines: Column, species: str = "Homo sapiens") -> Column:
    """Accessions of protein lines: ``#numbers# organism accession database <references>``, the middle two optional."""
    head = rf"^#[\d,]+#\s+{species}\s+([A-Z]\w*)(?:\s+\w+)?\s+<"
    found = F.transform(lines, lambda x: F.regexp_extract(x, head, 1))
    return F.array_distinct(F.filter(found, lambda x: x != ""))


def quoted_items(text: Column) -> Column:
    """``"a", "b"`` to ``[a, b]``."""
    return F.transform(F.split(text, r'"\s*,\s*"'), lambda x: F.replace(x, F.lit('"'), F.lit("")))


def missing_to_null(text: Column) -> Column:
    """Empty text and the word ``null`` count as missing."""
    return F.when((text != "") & (text != "null"), text)


def same_text(a: Column, b: Column | str) -> Column:
    """Case-insensitive equality."""
    return F.lower(a) == F.lower(F.lit(b) if isinstance(b, str) else b)
