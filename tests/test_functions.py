"""Golden cases of the scalar functions, with synthetic values."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from quillon.functions import ids, money, phone, text
from quillon.operators import layout, pricing, rules


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or ("x",)], ", ".join(f"{k} string" for k in values) or "x string")
    return row.select(column.alias("v")).first()["v"]


def test_identifiers(spark):
    number = one(spark, ids.head_office(F.col("x")), x="12345678")
    assert number == "12345678000195"
    assert one(spark, ids.is_valid_company(F.col("x")), x=number)
    assert not one(spark, ids.is_valid_company(F.col("x")), x="12345678000194")
    assert not one(spark, ids.is_valid_company(F.col("x")), x="11111111111111")
    assert one(spark, ids.is_valid_person(F.col("x")), x="529.982.247-25")
    assert one(spark, ids.masked(F.col("x")), x=number) == "12.345.678/0001-95"
    assert number in one(spark, ids.single_digit_repairs(F.col("x")), x="12345678000194")
    found = one(spark, ids.found(F.col("x")), x="ACME 12.345.678/0001-95 e 529.982.247-25")
    assert [tuple(f) for f in found] == [("CNPJ", number), ("CPF", "52998224725")]
    assert tuple(one(spark, ids.classify(F.col("x")), x="123")) == ("NONE", "123", ["DOC_LEN_3"])
    assert one(spark, ids.case_number(F.col("x")), x="00012341120208260001") == "0001234-11.2020.8.26.0001"
    assert one(spark, ids.case_state(F.col("x")), x="0001234-11.2020.8.26.0001") == "SP"


def test_money(spark):
    assert one(spark, money.parse_brl(F.col("x")), x="R$ 31.981.695,98") == Decimal("31981695.98")
    for bad in ("-1,00", "(1,00)", "1.23,00", "1,2", "", "abc"):
        assert one(spark, money.parse_brl(F.col("x")), x=bad) is None
    assert one(spark, money.format_brl(F.lit(Decimal("1234567.80"))), x="") == "R$ 1.234.567,80"
    assert tuple(one(spark, money.cell_value(F.col("x")), x="US$ 1.000,00 *")) == (Decimal("1000.00"), "USD")


@settings(max_examples=15, deadline=None)
@given(st.decimals(min_value=0, max_value=10**12, places=2))
def test_money_round_trip(spark, value):
    assert one(spark, money.parse_brl(money.format_brl(F.lit(value).cast("decimal(18,2)"))), x="") == value


def test_text(spark):
    assert one(spark, text.dedouble(F.col("x")), x="GGuussttaavvoo LLttddaa") == "Gustavo Ltda"
    assert one(spark, text.dedouble(F.col("x")), x="Anna Otto Lima Paz") == "Anna Otto Lima Paz"
    assert one(spark, text.norm(F.col("x")), x="  São João & Cia. ") == "SAO JOAO CIA"
    assert one(spark, text.tokens(F.col("x")), x="A 3M do Brasil 123") == ["3M", "BRASIL"]
    assert one(spark, text.acronym(F.col("x")), x="Empresa Mineira de Computadores") == "EMC"
    assert not one(spark, text.is_name(F.col("x")), x="Rua das Flores")
    assert one(spark, text.token_set_ratio(F.lit("ALFA BETA"), F.lit("BETA ALFA LTDA")), x="") == 100.0
    assert one(spark, text.blanked(F.col("x"), "^Pag"), x="Pag 1\nvalor") == "     \nvalor"


def test_phone(spark):
    cases = {"0800 123 4567": "0800 123 4567", "011 3333-4444": "(11) 3333-4444", "5511999998888": "(11) 99999-8888", "000": "", "33334444": "3333-4444 (no DDD)", "413333444": "(41) 3333-444 [digit missing]"}
    for raw, want in cases.items():
        assert one(spark, phone.dialable(F.col("x")), x=raw) == want


def test_links(spark):
    kinds = {"/lista-de-credores.pdf": ("LIST", 3), "/ata.pdf": ("SKIP", 0), "/plano.pdf": ("PLAN", 2), "/edital.pdf": ("LIST", 1), "/foto.png": ("OTHER", 0)}
    for href, want in kinds.items():
        assert tuple(one(spark, rules.link_kind(F.col("x"), F.lit("")), x=href)) == want


def test_company_named_total_is_no_total(spark):
    assert not one(spark, rules.is_total_line(F.col("x")), x="Total Transportes Ltda")
    assert one(spark, rules.is_total_line(F.col("x")), x="Total geral: R$ 1,00")


def test_split_value_is_joined(spark):
    frags = spark.createDataFrame([(1, "3", 10.0, 12.0), (1, "1.981.695,98", 13.0, 60.0), (1, "R$", 1.0, 5.0), (2, "9", 1.0, 2.0), (2, "02,44", 9.0, 20.0)], "g int, text string, x0 double, x1 double")
    got = {r["g"]: r["value"] for r in layout.best_value(layout.value_runs(frags, ["g"]), ["g"]).collect()}
    assert got == {1: "31.981.695,98", 2: "02,44"}


def test_bands_follow_the_first_word(spark):
    words = [(1, 1, f"w{t}", 0.0, 1.0, float(t)) for t in (10, 12, 14, 16, 30)]
    df = spark.createDataFrame(words, "doc_id long, page int, text string, x0 double, x1 double, top double")
    got = layout.bands_of_pages(df).orderBy("top").collect()
    assert [(b["top"], b["text"]) for b in got] == [(10.0, "w10 w12"), (14.0, "w14 w16"), (30.0, "w30")]


def test_positions_and_bands(spark):
    for share, want in ((2 / 3, "BLOCKING"), (0.5, "CONTROL"), (0.34, "SWING"), (0.2, None), (1.01, None)):
        assert one(spark, pricing.position(F.lit(share)), x="") == want


def test_kin_and_names(spark):
    from quillon.operators import resolve

    df = spark.createDataFrame([(["b", "a", "b", "a", "c"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(resolve.most_common(F.col("v"))).collect()] == ["b", None]
    people = spark.createDataFrame([([("José da Silva",), ("ACME LTDA",), ("Ana",)],)], "p array<struct<nome:string>>")
    assert people.select(resolve.partner_names(F.col("p"))).first()[0] == ["JOSE DA SILVA"]
    names = spark.createDataFrame([(f"ALFA {k} TEXTIL",) for k in ("UM", "DOIS", "TRES", "SETE", "OITO", "NOVE")] + [("BETA UNICA",)], "n string")
    assert {r["token"] for r in resolve.frequent_tokens(names, "n").collect()} == {"ALFA", "TEXTIL"}
    assert one(spark, resolve.needs_check(F.lit("Acme do Brasil"), F.lit("BETA TEXTIL")), x="")
    assert not one(spark, resolve.needs_check(F.lit("Beta"), F.lit("BETA TEXTIL")), x="")


def test_likeness_by_insertions_and_deletions():
    import itertools
    import random

    from quillon.functions import text

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(70))) for _ in range(2))
        assert text.common_length(a, b) == common(a, b)
    assert text.token_set_likeness("ALFA BETA", "BETA ALFA GAMA") == 100
    assert text.token_set_likeness("ALFA", "") == 0
    assert text.likeness("abcd", "bcde") == 75
    assert text.token_set_likeness("X ABCD", "X BCDE") == max(200 * common("X ABCD", "X BCDE") / 12, 200 * 1 / 7)
    for a, b in itertools.product(("abc", "xxabcxx", "axbxc", "", "bc"), repeat=2):
        short, long = sorted((a, b), key=len)
        n = len(short)
        want = max((200 * common(short, long[i:j]) / (n + j - i) for i in range(len(long) + 1) for j in range(i, len(long) + 1) if j - i <= n and (j - i == n or i == 0 or j == len(long)) and n + j - i), default=0.0 if long else 100.0)
        assert text.partial_likeness(a, b) == pytest.approx(want)
