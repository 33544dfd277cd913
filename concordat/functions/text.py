"""Text normalisation and parsing as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholders that count as missing, accents that are folded, and the word lists of the rules below.
PLACEHOLDERS = ["[ND]", "[nd]", "ND", "nan", "NaN", "None"]
ACCENTED = "ÉÈÊËàâäáéèêëîïíôöóûüúùçÀÂÄÁÎÏÍÔÖÓÛÜÚÙÇ"
FOLDED = "EEEEaaaaeeeeiiiooouuuucAAAAIIIOOOUUUUC"
LEGAL_FORMS = ["SAS", "SASU", "SARL", "EURL", "SCI", "SCIC", "SCOP", "SA", "SNC", "SELARL", "SELAS", "SELASU"]
NAME_STOPWORDS = ["LES", "DU", "DE", "LA", "LE", "DES", "D", "L", "AUX", "AU"]
ACRONYM_STOPWORDS = ["DE", "DU", "LA", "LE", "DES", "ET", "LES", "D", "L", "AUX", "AU"]
ACRONYM_PLACES = ["LYON", "CORBAS", "DECINES", "MEYZIEU", "VILLEURBANNE"]
STREET_WORDS = ["RUE", "AV", "AVE", "AVENUE", "BD", "BOULEVARD", "CHE", "CHEMIN", "IMP", "IMPASSE", "ALL", "ALLEE", "PL", "PLACE", "SQ", "SQUARE", "ROUTE", "RTE", "QUAI", "SENTIER", "ZA", "ZI", "ZAC"]
ASSOCIATION_WORDS = ["ASSOCIATION", "ASSO", "FOYER", "AMICALE", "CONSEIL", "PARENTS", "PARENT", "ELEVES", "SPORTIVE", "FSE", "SOCIO"]
SCHOOL_WORDS = ["COLLEGE", "CLG", "LYCEE", "LYCE", "ECOLE", "INSTITUT", "UNIVERSITE", "UFR", "FACULTE", "CTRE", "CENTRE", "FORMATION", "CFA", "MFR", "ACADEMY"]
GENERIC_WORDS = ["GROUPE", "SOCIETE", "HOLDING"]
ALIAS_BLACKLIST = ["SIEGE", "BAT", "BATIMENT", "ETAGE", "LOCAL", "AGENCE", "RDC"]
FIRST_NAMES = (
    "JEAN PIERRE PAUL JACQUES MICHEL ALAIN LOUIS CLAUDE GERARD FRANCOIS HENRI ANDRE RENE MARC DANIEL NICOLAS OLIVIER LAURENT ALEXANDRE THOMAS LUC ANTOINE SIMON VICTOR GABRIEL JULIEN YANN ARTHUR "
    "PAULINE MARIE ANNE NATHALIE CHRISTINE CATHERINE ISABELLE SOPHIE LAURENCE CELINE SANDRINE EMILIE JULIE ELISE LAURA ANNA SARAH CLARA EVA LENA LEA MANON MAELLE AMANDINE AUDREY MARION HELENE FLORENCE"
).split()


def words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x worked out once, however often f names it: expressions with lambdas are not shared by Catalyst."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def normalize_text(x: Column, uppercase: bool = True) -> Column:
    """'' for null and placeholders; else upper case, hyphens as spaces, listed accents folded, spaces collapsed."""
    t = F.upper(x) if uppercase else x
    t = collapse(F.translate(F.replace(t, F.lit("-"), F.lit(" ")), ACCENTED, FOLDED))
    return F.when(x.isNull() | F.trim(x).isin(PLACEHOLDERS), "").otherwise(t)


def tokens(x: Column) -> Column:
    return F.filter(F.split(x, " "), lambda w: w != "")


def strip_legal_terms(x: Column) -> Column:
    return F.array_join(F.filter(tokens(x), lambda w: ~w.isin(LEGAL_FORMS)), " ")


def truncate_name(x: Column, most: int = 100) -> Column:
    """Cut at the last space within most + 1 characters, or there."""
    head = F.substring(x, 1, most + 1)
    return F.when(F.length(x) <= most, x).when(F.instr(head, " ") > 0, F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head)


def normalize_name(x: Column, most: int = 100) -> Column:
    """Normalised, without legal forms unless nothing else is left, truncated."""
    return _named(normalize_text(x), most)


def _named(text: Column, most: int) -> Column:
    whole = lambda base: once(strip_legal_terms(base), lambda bare: F.when(bare == "", base).otherwise(bare))
    return once(once(text, whole), lambda t: truncate_name(t, most))


def normalize_name_cased(x: Column, most: int = 100) -> Column:
    """The same with its case kept; legal forms go where they stand in upper case."""
    return _named(normalize_text(x, uppercase=False), most)


def singular(w: Column) -> Column:
    """AUX to AL, a final S but not SS, a final X; alphabetic tokens of 5 characters or more; else null."""
    n = F.length(w)
    return F.when(
        w.rlike(r"^\p{L}+$") & (n >= 5),
        F.when(w.endswith("AUX") & (n >= 6), F.concat(F.substr(w, F.lit(1), n - 3), F.lit("AL")))
        .when(w.endswith("S") & ~w.endswith("SS"), F.substr(w, F.lit(1), n - 1))
        .when(w.endswith("X"), F.substr(w, F.lit(1), n - 1)),
    )


def normalize_for_tfidf(x: Column) -> Column:
    """Punctuation as spaces, acronyms of single-letter runs appended, distinct tokens each followed by its singular."""
    base = collapse(F.regexp_replace(normalize_text(x), r"[^\p{L}\p{N}_\s]", " "))
    runs = F.regexp_extract_all(F.concat(F.lit(" "), base, F.lit(" ")), F.lit(r"(?<= )((?:\p{L} ){2,})"), F.lit(1))
    all_ = F.concat(tokens(base), F.transform(runs, lambda r: F.replace(r, F.lit(" "), F.lit(""))))
    both = F.flatten(F.transform(all_, lambda w: F.filter(F.array(w, singular(w)), lambda v: v.isNotNull())))
    return F.array_join(F.array_distinct(both), " ")


def index_name(x: Column) -> Column:
    """The global index's rule: upper case, punctuation as spaces, accents kept."""
    return collapse(F.regexp_replace(F.upper(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "))


def embedding_text(x: Column) -> Column:
    """Camel case, acronym before a word, and digits are split apart; case is kept."""
    t = normalize_text(x, uppercase=False)
    t = F.regexp_replace(t, r"([a-z])([A-Z])", "$1 $2")
    t = F.regexp_replace(t, r"([A-Z]+)([A-Z][a-z])", "$1 $2")
    return collapse(F.regexp_replace(t, r"(\d+)", " $1 "))


def clean_text(x: Column, uppercase: bool = False) -> Column:
    """Collapsed, '' as null."""
    t = F.nullif(collapse(x), F.lit(""))
    return F.upper(t) if uppercase else t


def numeric_tokens(x: Column, most: int = 6) -> Column:
    """Distinct numbers of up to `most` digits; beyond 6 every run of digits counts, inside words too."""
    pattern = r"\b(\d{1,%d})\b" % most if most <= 6 else r"(\d+)"
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(pattern), F.lit(1)))


def name_tokens(x: Column, least: int = 2, stopwords: list[str] = NAME_STOPWORDS) -> Column:
    return F.array_distinct(F.filter(tokens(x), lambda w: ~w.isin(stopwords) & (F.length(w) >= least)))


def street_number(x: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(x), r"^(\d+)", 1), F.lit(""))


def street_of_address(x: Column) -> Column:
    return F.regexp_replace(F.trim(x), r"(?i)^\d+\s*(BIS|TER|QUATER|B|T|Q)?\s*", "")


def normalize_street(x: Column) -> Column:
    return F.array_join(F.filter(tokens(normalize_text(x)), lambda w: ~w.isin(STREET_WORDS)), " ")


def address_hash(number: Column, street: Column) -> Column:
    """'number|street', the street alone without a number, null without a street."""
    s, n = normalize_street(street), F.trim(F.coalesce(number, F.lit("")))
    return F.when(s == "", F.lit(None)).when(n == "", s).otherwise(F.concat_ws("|", n, s))


def build_address(number: Column, kind: Column, street: Column, other: Column) -> Column:
    main = F.concat_ws(" ", F.nullif(number, F.lit("")), F.nullif(kind, F.lit("")), F.nullif(street, F.lit("")))
    return normalize_text(F.coalesce(F.nullif(main, F.lit("")), other))


def split_address(x: Column) -> Column:
    """A CRM address as a struct (number with its suffix, street)."""
    pattern = r"(?i)^\s*(\d+(?:\s*(?:BIS|TER|QUATER)\b)?)\s*,?\s*(.*)$"
    found = x.rlike(pattern)
    return F.struct(F.when(found, F.regexp_extract(x, pattern, 1)).alias("number"), clean_text(F.when(found, F.regexp_extract(x, pattern, 2)).otherwise(x)).alias("street"))


def parse_address(x: Column) -> Column:
    """A free address as a struct (number or range, street, five-digit postcode, city)."""
    part = lambda p, g: F.nullif(F.trim(F.regexp_extract(x, p, g)), F.lit(""))
    return F.struct(part(r"^\s*(\d+(?:\s*-\s*\d+)?)", 1).alias("number"), part(r"^\s*(?:\d+(?:\s*-\s*\d+)?\s+)?([^,]+)", 1).alias("street"), part(r"\b(\d{5})\b", 1).alias("postcode"), part(r"\b\d{5}\s+([^,]+)", 1).alias("city"))


def strip_location(name: Column, city: Column, postcode: Column, insee: Column) -> Column:
    """The name without tokens of the city, the postcode and the commune code; itself if nothing is left."""
    gone = F.concat(tokens(normalize_text(city)), F.array(F.coalesce(postcode, F.lit("")), F.coalesce(insee, F.lit(""))))
    rest = lambda v: F.array_join(F.filter(tokens(v["n"]), lambda w: ~F.array_contains(v["gone"], w)), " ")
    some = lambda v: once(rest(v), lambda r: F.when(r == "", v["n"]).otherwise(r))
    return once(F.struct(once(name, lambda x: normalize_text(x)).alias("n"), gone.alias("gone")), some)


def aliases(name: Column) -> Column:
    """Normalised texts in round brackets, of 3 characters or more, no listed word, no number."""
    found = F.transform(F.regexp_extract_all(F.coalesce(name, F.lit("")), F.lit(r"\(([^)]+)\)"), F.lit(1)), lambda a: normalize_text(a))
    return F.filter(found, lambda a: (F.length(a) >= 3) & ~a.isin(ALIAS_BLACKLIST) & ~a.rlike(r"^\d+$"))


def is_person_name(x: Column) -> Column:
    t = tokens(normalize_text(x))
    return F.coalesce(F.size(t).between(2, 3) & ~x.rlike(r"\d") & ~F.arrays_overlap(t, words(LEGAL_FORMS)) & F.arrays_overlap(t, words(FIRST_NAMES)), F.lit(False))


def acronym_of(x: Column) -> Column:
    t = tokens(x)
    kept = F.filter(t, lambda w: ~F.upper(w).isin(ACRONYM_STOPWORDS + ACRONYM_PLACES))
    return F.when(F.size(t) <= 1, "").otherwise(F.upper(F.array_join(F.transform(kept, lambda w: F.substring(w, 1, 1)), "")))


def is_acronym(x: Column) -> Column:
    return F.replace(x, F.lit(" "), F.lit("")).rlike("^[A-Z]{2,6}$")


def acronym_match(a: Column, b: Column) -> Column:
    """1 if exactly one side looks like an acronym and equals or starts the other's initials."""
    def starts(short, long):
        return acronym_of(long).startswith(F.upper(F.replace(short, F.lit(" "), F.lit("")))).cast("int")

    return F.coalesce(F.when(is_acronym(a) & ~is_acronym(b), starts(a, b)).when(is_acronym(b) & ~is_acronym(a), starts(b, a)), F.lit(0))


def first_word_match(a: Column, b: Column) -> Column:
    return F.coalesce((F.try_element_at(tokens(a), F.lit(1)) == F.try_element_at(tokens(b), F.lit(1))).cast("int"), F.lit(0))


def contains(a: Column, b: Column) -> Column:
    """1 if b occurs in a, neither empty."""
    return F.coalesce(((a != "") & (b != "") & a.contains(b)).cast("int"), F.lit(0))
