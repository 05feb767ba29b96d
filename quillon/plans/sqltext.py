"""SQL for likeness of texts, which the oracles state with DuckDB's list functions."""

from __future__ import annotations


def common_length(a: str, b: str) -> str:
    """Length of the longest common subsequence of two string columns, row by row of the table."""
    cell = f"case when substr({a}, i, 1) = substr({b}, j, 1) then o[j] + 1 else greatest(o[j + 1], x[j]) end"
    row = f"list_reduce(range(1, length({b}) + 1), lambda x, j: list_append(x, {cell}), [0::bigint])"
    return f"list_reduce(range(1, length({a}) + 1), lambda o, i: {row}, list_transform(range(0, length({b}) + 1), lambda z: 0::bigint))[-1]"


def likeness(a: str, b: str) -> str:
    return f"(200.0 * {common_length(a, b)} / (length({a}) + length({b})))"


def token_sets(source: str, a: str, b: str) -> str:
    """CTEs that end in ``scored``: ``source`` plus score, the likeness of the word sets of normal names a and b."""
    words = lambda c: f"list_distinct(list_filter(string_split({c}, ' '), lambda w: w <> ''))"
    less = lambda x, y: f"array_to_string(list_sort(list_filter({x}, lambda w: not list_contains({y}, w))), ' ')"
    return f"""sets as (select *, {words(a)} as wa, {words(b)} as wb from {source}),
  sides as (select *, array_to_string(list_sort(list_intersect(wa, wb)), ' ') as wboth, {less("wa", "wb")} as resta, {less("wb", "wa")} as restb from sets),
  joined as (select *, trim(wboth || ' ' || resta) as sa, trim(wboth || ' ' || restb) as sb from sides),
  scored as (select *, case when len(wa) = 0 or len(wb) = 0 then 0.0 when resta = '' or restb = '' then 100.0
    else round(greatest({likeness("sa", "sb")}, case when wboth = '' then 0.0 else 200.0 * length(wboth) / (length(wboth) + length(sa)) end, case when wboth = '' then 0.0 else 200.0 * length(wboth) / (length(wboth) + length(sb)) end), 4) end as score from joined)"""
