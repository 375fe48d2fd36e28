import hashlib
import random
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from rostra.functions import keys, labels, names, numbers
from rostra.functions.evidence import evidence_text
from rostra.functions.similarity import batch_scores, integer_score, jaro_winkler

L = F.lit


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_keys_are_null_where_a_part_is_null(one):
    none = L(None).cast("string")
    assert one(keys.person_key("bioguide", L("A1"))) == md5("bioguide:A1")
    assert one(keys.person_key("bioguide", none)) is None
    assert one(keys.candidacy_key("fec", L("H1"), L(2024))) == md5("fec:H1:2024")
    args = [L("T1"), none, L(2021), L(None).cast("date"), none, L(500), L(1)]
    assert one(keys.contribution_key(*args)) is None
    args[1] = L("R1")
    assert one(keys.contribution_key(*args)) == md5("T1|R1|2021|||500|1")


def test_donor_key_ignores_case_and_blanks_but_not_in_the_zip(one):
    none = L(None).cast("string")
    a = one(keys.donor_key(L(" jane doe "), L("11201"), L("Acme ")))
    assert a == one(keys.donor_key(L("JANE DOE"), L("11201"), L("ACME"))) == md5("JANE DOE|11201|ACME")
    assert a != one(keys.donor_key(L("JANE DOE"), L("11201 "), L("ACME")))
    assert one(keys.donor_key(none, none, none)) == md5("||")


def test_vote_and_sponsorship_keys_fall_back(one):
    none = L(None).cast("string")
    assert one(keys.vote_key(none, L("Smith"), L("e1"), L("s"))) == md5("Smith:e1:s")
    assert one(keys.sponsorship_key(none, none, L("congress"))) == md5("::congress")


def test_integer_casts_round(one):
    assert one(numbers.to_int(L("12.7"))) == 13
    assert one(numbers.try_to_number(L("At Large"))) is None
    assert one(numbers.try_to_number(L(""))) is None
    assert one(numbers.try_to_number(L("07"))) == 7


def test_money_loses_its_cents_at_scale_zero(one):
    assert one(numbers.money(L("500.49"))) == 500
    assert one(numbers.money(L("0.49"))) == 0
    assert one(numbers.money(L("0.50"))) == 1
    assert one(numbers.money(L("500.49"), 2)) == Decimal("500.49")
    assert one(numbers.try_money(L(""))) is None


def test_div0(one):
    null = L(None).cast("double")
    assert one(numbers.div0(L(5.0), L(0.0))) == 0
    assert one(numbers.div0(null, L(0.0))) is None
    assert one(numbers.div0(L(5.0), null)) is None
    assert one(numbers.div0(L(5.0), L(2.0))) == 2.5
    assert one(numbers.percent(L(Decimal("1800000.00")), L(Decimal("5000000.00")))) == Decimal("36.0")
    assert one(numbers.share(L(1), L(16), 3)) == 0.063


def test_dates_of_all_sources(one):
    assert one(numbers.try_date(L("01/15/2021"))) == date(2021, 1, 15)
    assert one(numbers.try_date(L("2021-01-15"))) == date(2021, 1, 15)
    assert one(numbers.try_date(L("3-Jan-2025"))) == date(2025, 1, 3)
    assert one(numbers.try_date(L("2024-06-01T10:11:12"))) == date(2024, 6, 1)
    assert one(numbers.try_date(L(""))) is None
    assert one(numbers.try_timestamp(L("January 9, 2025,  02:54 PM"))) == datetime(2025, 1, 9, 14, 54)
    assert one(numbers.try_timestamp(L("2024-05-01T10:00:00"))) == datetime(2024, 5, 1, 10)


def test_names(one):
    assert one(names.surname_before_comma(L(" Smith , Jane"))) == "SMITH"
    assert one(names.surname_last_token(L("Jane Q Smith"))) == "SMITH"
    assert one(names.flip_name(L("O'NEIL-SMITH, J.R. ANN"))) == "J.R. Ann O'neil-Smith"
    assert one(names.flip_name(L("PLATO"))) == "Plato Plato"
    assert one(names.flip_name(L("GARCÍA, ÁNGEL"))) == "Ángel García"


def test_display_name(one):
    house = [L("Representative"), L("Smith, Jane"), L("Democratic"), L("NY"), L("house")]
    assert one(names.display_name(*house, L(14))) == "Representative Smith, Jane (D-NY-14)"
    senate = [L("Senator"), L("Wyden, Ron"), L("Democratic"), L("OR"), L("senate")]
    assert one(names.display_name(*senate, L(None).cast("int"))) == "Senator Wyden, Ron (D-OR)"
    senate[2] = L(None).cast("string")
    assert one(names.display_name(*senate, L(None).cast("int"))) is None


def test_labels(one):
    assert one(labels.vote_option(L("AYE"))) == "yes"
    assert one(labels.vote_option(L("Not Voting"))) == "abstain"
    assert one(labels.vote_option(L("Guilty"))) == "guilty"
    assert one(labels.vote_option(L(None).cast("string"))) == ""
    assert one(labels.tier(L(60.0))) == "High"
    assert one(labels.tier(L(30.0))) == "Medium"
    assert one(labels.tier(L(29.9))) == "Low"
    assert one(labels.tier(L(None).cast("double"))) == "Low"
    assert one(labels.decode(L("Z"), labels.DESIGNATIONS)) == "Z"


def test_evidence(one):
    args = [L(Decimal("1800000.40")), L(Decimal("36.0")), L(Decimal("5000000.50")), L(2024)]
    text = one(evidence_text(*args, L("Senate Finance"), L("")))
    assert text == (
        "Received $1,800,000 from PACs and political committees (36.0% of $5,000,001 total raised "
        "in 2024). Sits on: Senate Finance. These committees oversee: ."
    )
    none = L(None).cast("string")
    assert one(evidence_text(*args, none, none)).endswith("No committee assignment data available yet.")
    args[0] = L(None).cast("decimal(18,2)")
    assert one(evidence_text(*args, none, none)) is None


def _random_pairs(n, seed=5):
    rnd = random.Random(seed)
    alphabet = "ABCDEFGHIJKLMNOP"
    pairs = []
    for _ in range(n):
        a = [rnd.choice(alphabet[: rnd.choice([3, 8, 16])]) for _ in range(rnd.randint(0, 12))]
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            if b and kind < 0.4:
                i, j = rnd.randrange(len(b)), rnd.randrange(len(b))
                b[i], b[j] = b[j], b[i]
            elif b and kind < 0.6:
                b.pop(rnd.randrange(len(b)))
            else:
                b.insert(rnd.randint(0, len(b)), rnd.choice(alphabet))
        pairs.append(("".join(a), "".join(b)))
    return pd.DataFrame(pairs, columns=["a", "b"])


def test_similarity_equals_duckdb_and_is_symmetric():
    df = _random_pairs(20_000)
    df["s"] = batch_scores(df.a, df.b)
    worst = duckdb.sql("select max(abs(s - jaro_winkler_similarity(a, b))) from df").fetchall()[0][0]
    assert worst < 1e-12
    assert ((df.s >= 0) & (df.s <= 1)).all()
    assert (batch_scores(df.b, df.a) - df.s).abs().max() < 0.2


def test_similarity_of_missing_empty_and_accented_names(one):
    none = L(None).cast("string")
    assert one(jaro_winkler(L("A"), none)) is None
    assert one(jaro_winkler(L(""), L(""))) == 0
    assert one(jaro_winkler(L("GARCÍA"), L("GARCÍA"))) == 1
    # Characters are compared, not bytes: one of six differs.
    assert abs(one(jaro_winkler(L("GARCÍA"), L("GARCIA"))) - (8 / 9 + 0.4 / 9)) < 1e-12
    assert one(integer_score(jaro_winkler(L("MARTHA"), L("MARHTA")))) == 96


def test_long_names_stay_in_memory():
    a = pd.Series(["X" * 20_000 + "A", "SHORT"])
    b = pd.Series(["X" * 20_000 + "B", "SHOTR"])
    scores = batch_scores(a[1:], b[1:])
    assert 0.9 < scores.iloc[0] < 1
