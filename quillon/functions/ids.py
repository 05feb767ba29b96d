"""Company and person identifiers: digits, check digits, masks, repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Modulo-11 weights of the 14-digit and the 11-digit identifier.
COMPANY_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
PERSON_WEIGHTS = (10, 9, 8, 7, 6, 5, 4, 3, 2)
#: Court code (characters 19-20 of a case number) to state.
COURT_STATE = {
    "01": "AC", "02": "AL", "03": "AP", "04": "AM", "05": "BA", "06": "CE", "07": "DF", "08": "ES", "09": "GO",
    "10": "MA", "11": "MT", "12": "MS", "13": "MG", "14": "PA", "15": "PB", "16": "PR", "17": "PE", "18": "PI",
    "19": "RJ", "20": "RN", "21": "RS", "22": "RO", "23": "RR", "24": "SC", "25": "SE", "26": "SP", "27": "TO",
}


def digits(x: Column) -> Column:
    """Digits only; null becomes ''."""
    return F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), "[^0-9]", "")


def _bound(x: Column, use) -> Column:
    """``use`` of the value of ``x``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(x), use), 1)


def _weighed(n: Column, weights) -> Column:
    """Sum of the digits of ``n``, as many as there are weights, times these."""
    digit = lambda i: F.call_function("div", n, F.lit(10 ** (len(weights) - i))) % 10
    return sum((digit(i) * w for i, w in enumerate(weights, 1)), F.lit(0))


def check_digit(d: Column, weights) -> Column:
    """Modulo-11 digit over the first digits of ``d``, as arithmetic on one number; null if it has fewer."""
    size = len(weights)
    # 11 less the rest; rests of 0 and 1 give 0
    last = _bound(F.substring(d, 1, size).try_cast("bigint"), lambda n: (11 - _weighed(n, weights) % 11) % 11 % 10)
    return F.when(F.length(d) >= size, last.cast("int"))


def _uniform(d: Column) -> Column:
    return d == F.repeat(F.substring(d, 1, 1), F.length(d))


def _valid(d: Column, length: int, weights, more) -> Column:
    """Whether ``d``, digits only, has the length and its two check digits."""
    first = check_digit(d, weights) == F.substring(d, length - 1, 1).try_cast("int")
    second = check_digit(d, more) == F.substring(d, length, 1).try_cast("int")
    return F.coalesce((F.length(d) == length) & ~_uniform(d) & first & second, F.lit(False))


def is_valid_company(x: Column) -> Column:
    return _bound(digits(x), lambda d: _valid(d, 14, COMPANY_WEIGHTS, (6, *COMPANY_WEIGHTS)))


def is_valid_person(x: Column) -> Column:
    return _bound(digits(x), lambda d: _valid(d, 11, PERSON_WEIGHTS, (11, *PERSON_WEIGHTS)))


def root(x: Column) -> Column:
    return F.substring(digits(x), 1, 8)


def with_check_digits(base12: Column) -> Column:
    """A 12-digit base with its two check digits; '' for a shorter base."""
    base = F.substring(digits(base12), 1, 12)
    n = F.when(F.length(base) >= 12, base).try_cast("bigint")
    last = lambda total: ((11 - total % 11) % 11 % 10).cast("int")
    # plain arithmetic, which is compiled; inside a function of an array it would be interpreted
    one = last(_weighed(n, COMPANY_WEIGHTS))
    two = last(_weighed(n, (6, *COMPANY_WEIGHTS)[:12]) + one * COMPANY_WEIGHTS[-1])
    return F.coalesce(F.concat(base, one.cast("string"), two.cast("string")), F.lit(""))


def head_office(root8: Column) -> Column:
    return with_check_digits(F.concat(F.substring(digits(root8), 1, 8), F.lit("0001")))


def masked(x: Column) -> Column:
    """12.345.678/0001-95; other lengths pass as digits."""
    return F.regexp_replace(digits(x), "^([0-9]{2})([0-9]{3})([0-9]{3})([0-9]{4})([0-9]{2})$", "$1.$2.$3/$4-$5")


def classify(x: Column) -> Column:
    """struct(kind, digits, flags) by length and validity."""
    d = digits(x)
    n = F.length(d)
    none = F.array().cast("array<string>")
    kind = F.when(n == 14, "CNPJ").when(n == 11, "CPF").otherwise("NONE")
    flags = (
        F.when(n == 14, F.when(is_valid_company(d), none).otherwise(F.array(F.lit("CNPJ_INVALID"))))
        .when(n == 11, F.when(is_valid_person(d), F.array(F.lit("INDIVIDUAL"))).otherwise(F.array(F.lit("INDIVIDUAL"), F.lit("CPF_INVALID"))))
        .when(n == 0, F.array(F.lit("NO_DOCUMENT")))
        .otherwise(F.array(F.concat(F.lit("DOC_LEN_"), n.cast("string"))))
    )
    return F.struct(kind.alias("kind"), d.alias("digits"), flags.alias("flags"))


def single_digit_repairs(x: Column) -> Column:
    """Sorted valid identifiers that differ from ``x`` in exactly one digit.

    Both weighted sums are worked out once; a change of one digit moves each by
    the difference times the digit's weight.
    """
    d = digits(x)
    more = (6, *COMPANY_WEIGHTS)
    div = lambda a, b: F.call_function("div", a, b)
    last = lambda total: (11 - total % 11) % 11 % 10
    # of each place its unit and its weights in the two sums; a sum's own digit and what follows weigh nothing
    places = [F.struct(F.lit(10 ** (13 - i)).cast("bigint").alias("unit"), *[F.lit((*w, 0, 0)[i]).alias(k) for k, w in (("one", COMPANY_WEIGHTS), ("two", more))]) for i in range(14)]

    def repaired(s):
        def at(p):
            was = div(s["n"], p["unit"]) % 10

            def sound(c):
                by, n = c - was, s["n"] + (c - was) * p["unit"]
                first, second = last(s["one"] + by * p["one"]) == div(n, F.lit(10)) % 10, last(s["two"] + by * p["two"]) == n % 10
                return (c != was) & second & first & (n % 11111111111111 != 0)

            return F.transform(F.filter(F.sequence(F.lit(0), F.lit(9)), sound), lambda c: s["n"] + (c - was) * p["unit"])

        return F.flatten(F.transform(F.array(*places), at))

    def sums(n):
        two = div(n, F.lit(10))
        return F.struct(n.alias("n"), _weighed(div(n, F.lit(100)), COMPANY_WEIGHTS).alias("one"), _weighed(two, more).alias("two"))

    number = F.when(F.length(d) == 14, d.try_cast("bigint"))
    found = _bound(_bound(number, sums), repaired)
    # numbers of one length sort as their texts do; no number has no repairs
    return F.transform(F.array_sort(found), lambda n: F.lpad(n.cast("string"), 14, "0"))


def found(text: Column) -> Column:
    """Company identifiers of a text, then person identifiers outside them.

    Company matches are replaced by a mark before persons are sought, which is
    the same as leaving out persons inside a company's span.
    """
    company, person = r"[0-9]{2}\.?[0-9]{3}\.?[0-9]{3}/?[0-9]{4}-?[0-9]{2}", r"[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}"
    t = F.coalesce(text, F.lit(""))
    one = F.transform(F.regexp_extract_all(t, F.lit(company), F.lit(0)), lambda m: F.struct(F.lit("CNPJ").alias("kind"), digits(m).alias("digits")))
    two = F.transform(F.regexp_extract_all(F.regexp_replace(t, company, "#"), F.lit(person), F.lit(0)), lambda m: F.struct(F.lit("CPF").alias("kind"), digits(m).alias("digits")))
    return F.concat(one, two)


def case_number(x: Column) -> Column:
    """NNNNNNN-DD.AAAA.J.TR.OOOO from 20 digits; else as it came."""
    d = digits(x)
    mask = F.regexp_replace(d, "^([0-9]{7})([0-9]{2})([0-9]{4})([0-9])([0-9]{2})([0-9]{4})$", "$1-$2.$3.$4.$5.$6")
    return F.when(F.length(d) == 20, mask).otherwise(x)


def case_year(case: Column) -> Column:
    return F.nullif(F.regexp_extract(case, r"^[0-9]{7}-[0-9]{2}\.([0-9]{4})\.", 1), F.lit("")).try_cast("int")


def case_state(case: Column) -> Column:
    table = F.create_map(*[F.lit(v) for pair in COURT_STATE.items() for v in pair])
    return F.try_element_at(table, F.substring(case, 19, 2))


def is_state_court(case: Column) -> Column:
    return F.substring(case, 17, 1) == "8"
