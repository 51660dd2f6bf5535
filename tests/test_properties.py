"""Property tests for the pure helpers (no Spark needed)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.functions.names import qualify, quote, split_name
from quarry.functions.params import statements_of, substitute
from quarry.sinks.expiry import expired_days

ident = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"),
                min_size=1, max_size=12)


@given(st.lists(ident, min_size=1, max_size=3))
def test_quoted_names_split_back(parts):
    assert split_name(".".join(quote(p) for p in parts)) == [p.strip() for p in parts]


@given(ident, ident, ident)
def test_qualify_puts_project_and_dataset_first(t, d, p):
    assert split_name(qualify(quote(t), quote(d), quote(p))) == [x.strip() for x in (p, d, t)]


names = st.from_regex(r"[A-Za-z_][A-Za-z0-9_]{0,8}", fullmatch=True)


@given(st.dictionaries(names, st.text(alphabet="abc 123'", max_size=6), max_size=4))
def test_substitute_replaces_every_placeholder(params):
    sql = " AND ".join(f"c_{k} = '${{{k}}}'" for k in params) or "SELECT 1"
    out = substitute(sql, params)
    assert "${" not in out
    for k, v in params.items():
        assert f"c_{k} = '{v}'" in out


pieces = st.lists(st.sampled_from(["select 1", "select ';'", "-- a ; b\nselect 2", "/* ; /* ; */ */ select 3",
                                   'select ";"', "select `a;b`", "select 'it\\'s;'"]), min_size=1, max_size=5)


@given(pieces, st.sampled_from([";", " ;\n", ";;", "; -- only a comment\n;"]))
def test_statements_split_only_outside_quotes_and_comments(parts, sep):
    found = statements_of(sep.join(parts) + ";")
    assert [f.split("\n")[-1] if "only" in f else f for f in found] == parts


days = st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 1, 1))


@settings(max_examples=200)
@given(st.lists(days, max_size=20, unique=True), st.integers(0, 10**11),
       st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 1, 1)))
def test_expiry_rule(ds, ms, as_of):
    gone = set(expired_days([d.isoformat() for d in ds], ms, as_of))
    for d in ds:
        start = dt.datetime.combine(d, dt.time())
        assert (d.isoformat() in gone) == (start + dt.timedelta(milliseconds=ms) <= as_of)


def test_same_path_ignores_spelling(spark):
    from quarry.sources.files import same_path
    assert same_path(spark, "file:/tmp/a/", "/tmp/a")
    assert same_path(spark, "file:///tmp/a", "/tmp//a")
    assert not same_path(spark, "/tmp/a", "/tmp/b")


def test_project_alone_takes_the_current_database():
    import pytest
    assert qualify("t", None, "c", current="d") == "`c`.`d`.`t`"
    with pytest.raises(ValueError):
        qualify("t", None, "c")


def test_sibling_keeps_the_namespace():
    from quarry.functions.names import sibling
    assert sibling("`c`.`db`.`t`", "t__x") == "`c`.`db`.`t__x`"
    assert sibling("`t`", "u") == "`u`"
