import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordat.functions import codes as C
from concordat.functions import similarity as S
from concordat.functions import text as T


def one(spark, make, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "f, given_, want",
    [
        (T.normalize_text, "  École-Élémentaire  Jules ", "ECOLE ELEMENTAIRE JULES"),
        (T.normalize_text, "[ND]", ""),
        (T.normalize_text, "nan", ""),
        (T.normalize_text, None, ""),
        (T.normalize_name, "SARL Dupont", "DUPONT"),
        (T.normalize_name, "SAS", "SAS"),
        (T.normalize_for_tfidf, "J.N.C. Travaux", "J N C TRAVAUX TRAVAL JNC"),
        (T.embedding_text, "DigitBoxing15Pro", "Digit Boxing 15 Pro"),
        (T.numeric_tokens, "APAJH 69", ["69"]),
        (C.normalize_code, "69150.0", "69150"),
        (C.normalize_code, "", None),
        (C.normalize_code, "2A004", "2A004"),
        (C.department, "97411", "974"),
        (C.department, "69381", "69"),
        (C.department, "2A004", "2A"),
        (C.naf_section, "70.22Z", "M"),
        (C.naf_section, "x", None),
        (T.is_person_name, "Jean Dupont", True),
        (T.is_person_name, "SARL Jean", False),
        (T.street_of_address, "12 BIS RUE DE LYON", "RUE DE LYON"),
    ],
)
def test_values(spark, f, given_, want):
    assert one(spark, f, given_) == want


def test_addresses(spark):
    a = one(spark, T.parse_address, "15-17 Rue Emile Zola, 69150 Décines-Charpieu")
    assert tuple(a) == ("15-17", "Rue Emile Zola", "69150", "Décines-Charpieu")
    assert one(spark, T.address_hash, "12", "RUE DE LYON") == "12|DE LYON"
    assert one(spark, T.address_hash, None, "RUE") is None


def test_similarities(spark):
    assert one(spark, T.acronym_match, "SNCF", "SOCIETE NATIONALE CHEMINS FER") == 1
    assert [one(spark, S.number_gap, *x) for x in (("12", "15"), (None, "3"), ("12B", "3"))] == [3.0, 9999.0, 9999.0]
    assert one(spark, C.arrondissements, "69123") == [str(i) for i in range(69381, 69390)]
    assert S.jaro_winkler_of("MARTHA", "MARHTA") == pytest.approx(0.961111, abs=1e-6)
    assert (S.jaro_winkler_of("", ""), S.jaro_winkler_of("", "A")) == (1.0, 0.0)
    assert one(spark, S.levenshtein_ratio, "", "") == 1.0


@settings(max_examples=200, deadline=None)
@given(st.text("ABCDE ", max_size=12), st.text("ABCDE ", max_size=12))
def test_jaro_winkler_against_duckdb(a, b):
    if a or b:
        want = duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert S.jaro_winkler_of(a, b) == pytest.approx(want, abs=1e-9)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ABé\0 ", max_size=70), st.text("ABé\0 ", max_size=70)), max_size=30))
def test_jaro_winkler_batch(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    assert S.jaro_winkler_batch(a, b).tolist() == pytest.approx([S.jaro_winkler_of(x, y) for x, y in pairs])


def test_postal_codes(spark):
    assert one(spark, lambda c: F.size(C.postal_codes(c)), "69") == 1000
    got = one(spark, C.postal_codes, "69")
    assert got[0] == "69000" and got[-1] == "69999"
    assert one(spark, C.postal_codes, "974")[:2] == ["97400", "97401"]
