"""Landing by several landers at once, and what a dead one leaves."""

import threading
from datetime import date

import pytest

from tidemark.sources import bronze, claims
from tidemark.sources.bronze import count_lines, land_bronze, read_bronze_lines

DAY = date(2024, 1, 1)


def lines(spark, hours, copies=3):
    data = [(f'{{"id": "{h}-{i}"}}', DAY, h) for h in hours for i in range(copies)]
    return spark.createDataFrame(data, "value string, source_date date, source_hour int")


def landed(spark, root):
    return {r.source_hour: r.raw_rows for r in count_lines(read_bronze_lines(spark, root)).collect()}


def test_two_landers_leave_one_set_of_lines(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    barrier = threading.Barrier(2)
    make = claims._make
    met = threading.local()

    def together(*args):
        # both have listed the hours as missing before either claims one
        if not getattr(met, "yet", False):
            met.yet = True
            barrier.wait(60)
        return make(*args)

    monkeypatch.setattr(claims, "_make", together)
    out = {}

    def land(name):
        out[name] = land_bronze(lines(spark, [1, 2, 3, 4]), root)

    threads = [threading.Thread(target=land, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    hours = sorted(out["a"] + out["b"])
    assert hours == [(DAY, h) for h in (1, 2, 3, 4)]
    assert landed(spark, root) == {h: 3 for h in (1, 2, 3, 4)}
    assert not list((tmp_path / "bronze" / claims.CLAIMS).iterdir())


def test_of_many_callers_one_gets_a_claim(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / claims.CLAIMS).mkdir()
    got = []
    threads = [threading.Thread(target=lambda: got.append(claims.claim(spark, root, "date=x/hour=1"))) for _ in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 11 + [True]
    claims.release(spark, root, "date=x/hour=1")
    assert claims.claim(spark, root, "date=x/hour=1")


def test_landing_skips_claimed_hours_and_breaks_stale_claims(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    with claims.claimed(spark, root, {bronze.bronze_partition(DAY, 1): 1}) as held:
        assert held == [1]
        assert land_bronze(lines(spark, [1, 2]), root) == [(DAY, 2)]
    # released without a landing, as by a writer that failed
    assert land_bronze(lines(spark, [1, 2]), root) == [(DAY, 1)]
    assert claims.claim(spark, root, bronze.bronze_partition(DAY, 3))
    assert land_bronze(lines(spark, [3]), root) == []
    monkeypatch.setattr(claims, "STALE_MS", -60_000)
    assert land_bronze(lines(spark, [3]), root) == [(DAY, 3)]
    assert landed(spark, root) == {1: 3, 2: 3, 3: 3}


def test_a_failed_landing_releases_its_claims(spark, tmp_path):
    root = str(tmp_path / "bronze")
    bad = lines(spark, [5]).selectExpr("raise_error('no') value", "source_date", "source_hour")
    with pytest.raises(Exception, match="no"):
        land_bronze(bad, root)
    assert land_bronze(lines(spark, [5]), root) == [(DAY, 5)]
