"""Listings: pages, pushed filters, odd names."""

import io
from contextlib import redirect_stdout

import pytest

from tapeloom.sources import listing

NAMES = ["a", "b/c é%", "long"]


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("site"))
    rows = [(n, i, f"{n} {i}\nx", f"u{i}") for n, k in zip(NAMES, (1, 3, 25)) for i in range(k)]
    listing.write_listing(spark.createDataFrame(rows, listing.SCHEMA), path, page=10)
    return path, rows


def explained(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_all(spark, site):
    path, rows = site
    df = listing.read_listing(spark, path)
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    assert df.rdd.getNumPartitions() == 5
    for n in NAMES:
        assert [(n, *r) for r in listing.playlist(spark, path, n).orderBy("seq").collect()] == [r for r in rows if r[0] == n]


def test_pushed_filters(spark, site):
    path, rows = site
    one = listing.video(spark, path, "long", 12)
    assert [tuple(r) for r in one.collect()] == [(12, "long 12\nx", "u12")] and one.rdd.getNumPartitions() == 1
    plan = explained(one)
    assert "PushedFilters" in plan and "EqualTo(seq,12)" in plan.replace(" ", "") and "EqualTo(playlist,long)" in plan.replace(" ", "")
    for where, holds, tasks in (
        ("playlist in ('a', 'b/c é%', 'none')", lambda r: r[0] in NAMES[:2], 2),
        ("seq >= 10 and seq < 20", lambda r: 10 <= r[1] < 20, 1),
        ("seq > 9 and seq <= 20 and seq <= 10", lambda r: r[1] == 10, 1),
        ("seq > 24", lambda r: False, 1),
        ("title like 'long 1%' and seq > 3", lambda r: r[2].startswith("long 1") and r[1] > 3, 3),
        ("playlist = 'none'", lambda r: False, 1),
        ("playlist > 'b' and playlist <> 'long'", lambda r: r[0] == NAMES[1], 5),
    ):
        got = listing.read_listing(spark, path).where(where)
        assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if holds(r)), where
        assert got.rdd.getNumPartitions() == tasks, where


def test_empty(spark, tmp_path):
    listing.write_listing(spark.createDataFrame([], listing.SCHEMA), str(tmp_path))
    assert listing.read_listing(spark, str(tmp_path)).count() == 0
