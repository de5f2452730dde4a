"""The Column parsers against the plain-Python meaning they re-express
(``str.zfill``, ``re.findall`` ranges, ``split(':')`` headings, ``float``
money), on random text. Inputs are kept to the shapes where the Python
meaning is defined (ASCII, numbers without exponents or underscores)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions import scalars as S

SETTINGS = dict(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ASCII = st.text(alphabet=st.sampled_from(list("abcXYZ019 :<>=-+.,$()%\t")), max_size=24)


def _run(spark, values, *cols):
    df = spark.createDataFrame([(v,) for v in values], "t STRING")
    return [tuple(r) for r in df.select(*cols).collect()]


@settings(**SETTINGS)
@given(values=st.lists(st.text(alphabet=st.sampled_from(list("0123456789+-ab")), max_size=8), min_size=1,
                       max_size=20))
def test_zfill_matches_python(spark, values):
    got = [r[0] for r in _run(spark, values, S.zfill("t", 5))]
    assert got == [v.zfill(5) for v in values]


def _py_range(s):
    nums = re.findall(r"-?\d+\.?\d*", s)
    if len(nums) >= 2:
        return float(nums[0]), float(nums[-1])
    if len(nums) == 1:
        return (None, float(nums[0])) if "<" in s else (float(nums[0]), None)
    return None, None


@settings(**SETTINGS)
@given(values=st.lists(ASCII, min_size=1, max_size=20))
def test_parse_range_matches_python(spark, values):
    r = S.parse_range("t")
    got = _run(spark, values, r["lower"], r["upper"])
    assert got == [_py_range(v) for v in values]


@settings(**SETTINGS)
@given(values=st.lists(ASCII, min_size=1, max_size=20))
def test_split_heading_matches_python(spark, values):
    code, name = S.split_heading("t")
    got = _run(spark, values, code, name)
    assert got == [(v.split(":")[0].strip(), v.split(":")[-1].strip()) for v in values]


MONEY = st.builds(lambda sign, ints, dec, paren, spaces: (" " * spaces) + ("(" if paren else "") + "$" + sign
                  + f"{ints:,}" + dec + (")" if paren else ""),
                  st.sampled_from(["", "-"]), st.integers(0, 10_000_000),
                  st.sampled_from(["", ".5", ".25", ".", ".00"]), st.booleans(), st.integers(0, 2))


def _py_money(s):
    cleaned = s.replace("$", "").strip()
    sign = -1 if cleaned.startswith("(") and cleaned.endswith(")") else 1
    cleaned = cleaned.strip("()").replace(",", "")
    try:
        return sign * float(cleaned)
    except ValueError:
        return None


@settings(**SETTINGS)
@given(values=st.lists(st.one_of(MONEY, ASCII), min_size=1, max_size=20))
def test_parse_money_matches_python(spark, values):
    got = [r[0] for r in _run(spark, values, S.parse_money("t"))]
    want = [_py_money(v) for v in values]
    for g, w, v in zip(got, want, values):
        if w is None or g is None:
            # the regex guard may only be stricter than float() (e.g. "inf"); never looser
            assert g is None, v
        else:
            assert abs(g - w) < 1e-9, v


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _key(s):
    return re.sub(r"\s+", "", re.sub(r"\b(and|inc|care|group)\b", "", s))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names=st.dictionaries(st.text(alphabet=st.sampled_from(list("ab c")), max_size=5),
                             st.integers(1, 4), min_size=1, max_size=25))
def test_typo_map_matches_brute_force(spark, names):
    from tidemark.operators.entities import typo_map
    df = spark.createDataFrame(list(names.items()), "name STRING, n LONG")
    rank = {k: (-v, k) for k, v in names.items()}
    for min_dist in (2, 3):
        got = {r.name: r.target for r in typo_map(df, "name", "n", min_dist=min_dist).collect()}
        want = {}
        for a in names:
            cands = [b for b in names if b != a and _lev(_key(a), _key(b)) < min_dist and rank[b] < rank[a]]
            if cands:
                want[a] = min(cands, key=lambda b: rank[b])
        assert got == want, min_dist


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=st.lists(st.tuples(st.datetimes(min_value=__import__("datetime").datetime(2015, 1, 1),
                                             max_value=__import__("datetime").datetime(2030, 12, 31)),
                                st.sampled_from(sorted(S.ZONE_NAMES) + [""])), min_size=1, max_size=20))
def test_zoned_timestamp_matches_zoneinfo(spark, items):
    import datetime as dt
    from zoneinfo import ZoneInfo
    texts, want = [], []
    for local, zone in items:
        local = local.replace(microsecond=0)
        tz = ZoneInfo(S.ZONE_NAMES[zone or S.DEFAULT_ZONE_NAME])
        aware = local.replace(tzinfo=tz)
        # skip the ambiguous / missing hour around DST changes (Q16)
        if aware.utcoffset() != local.replace(tzinfo=tz, fold=1).utcoffset():
            continue
        if aware.astimezone(dt.timezone.utc).astimezone(tz).replace(tzinfo=None) != local:
            continue
        texts.append(local.strftime("%m/%d/%Y %I:%M:%S %p") + (" " + zone if zone else ""))
        want.append(aware.astimezone(dt.timezone.utc).replace(tzinfo=None))
    if not texts:
        return
    got = [r[0] for r in _run(spark, texts, S.parse_zoned_timestamp("t").cast("timestamp_ntz"))]
    assert got == want
