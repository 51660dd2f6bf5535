"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Each text gets a vector of transformed statistics: word length, and the shares
of symbols, capitals, repeated lines and repeated words. Per language and
source, per language, and over all rows, a minimum-covariance-determinant
estimate gives centre and scatter. There are three deterministic starts, around
the medians: absolute deviations alone; with the correlations of the hyperbolic
tangents of the standardised rows; and with those of their spatial signs. From
each, concentration steps take the three quarters of the rows that lie nearest,
estimate mean and covariance from them, and measure all rows again. The start
that ends with the least determinant wins. Scatters are scaled so that the
median distance is that of chi-square. A language and source is judged by its
own estimate and its language's, mixed in the weights n and ``GROUP_ROWS`` for n
rows that pass the base rule; a language likewise by its own and that over all
rows. A row beyond ``CUTOFF`` is rejected.

Estimates are sums and counts with map-side aggregation: a group that holds a
third of all rows is no task of its own. Quantiles are taken of values rounded
to a thousandth, so their state is bounded too.

Defined cases: a null text has no words and fails the base rule; null
languages and sources are groups like any other; a null ``doc_id`` is kept;
repeated rows count each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content, stored

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÉÈÊËÍÎÏÑÓÔÖÙÚÛÜŸ"
WINDOW = 5
FEATURES = ("f0", "f1", "f2", "f3", "f4")
#: The median of chi-square with as many degrees of freedom as there are features.
CHI2_MEDIAN = 4.3515
#: Squared distance beyond which a row is an outlier. Far beyond any quantile of chi-square,
#: as the shares aren't normal: clean texts with a repeated line or a list reach 100 to 200.
CUTOFF = 250.0
#: Standard deviations below this don't count as smaller: a feature most rows have at zero has no scatter of its own.
FLOOR = (0.05, 0.25, 0.25, 0.25, 0.25)
SHARE = 0.75
STARTS = 3
STEPS = 3
#: The rows at which a group's own estimate counts as much as that of the level above it.
GROUP_ROWS = 200
#: Rows of a table with one row per group, of some twenty numbers, that may be broadcast: 16 MB at most.
BROADCAST_GROUPS = 100_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that the text holds twice or more (all of them counted)."""
    n = F.size(words) - window + 1

    def covered(at: Column) -> Column:  # the sorted starts of such windows: each covers up to the next one
        gaps = F.aggregate(F.sequence(F.lit(0), F.size(at) - 2), F.lit(0).cast("long"),
                           lambda acc, k: acc + F.least(F.lit(window), F.get(at, k + 1) - F.get(at, k)))
        return F.when(F.size(at) > 1, gaps).otherwise(F.lit(0)) + window

    def starts(sorted_windows: Column) -> Column:
        def twice(j: Column) -> Column:
            own = F.get(sorted_windows, j)["h"]
            return (F.coalesce(F.get(sorted_windows, j - 1)["h"] == own, F.lit(False))
                    | F.coalesce(F.get(sorted_windows, j + 1)["h"] == own, F.lit(False)))

        found = F.filter(F.sequence(F.lit(0), F.size(sorted_windows) - 1), twice)
        return F.sort_array(F.transform(found, lambda j: F.get(sorted_windows, j)["i"]))

    def count(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(let(order, starts), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(repeated)

    hashes = F.transform(F.sequence(F.lit(0), n - 1),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))
    return F.when(n > 1, let(hashes, count)).otherwise(F.lit(0).cast("long"))


def without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The statistics of every row of ``docs``, next to doc_id, lang, source and ``keep``."""
    text = F.col("__text")
    by_word = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                     repeat_words(w).alias("n_repeat_words")))
    has_word = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACE, "") != "")
    by_line = let(has_word, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                               (F.size(x) - F.size(F.array_distinct(x))).cast("long")
                                               .alias("n_dup_lines")))
    rows = docs.select("doc_id", "lang", "source", *keep, content().alias("__text"))
    return (rows.select("doc_id", "lang", "source", *keep, by_word.alias("w"), by_line.alias("l"),
                        F.length(text).cast("long").alias("n_all"),
                        without(text, SPACE).cast("long").alias("word_chars"),
                        without(text, SYMBOLS).alias("no_symbols"), without(text, CAPITALS).alias("no_capitals"))
            .select("doc_id", "lang", "source", *keep, "w.n_words", "word_chars",
                    (F.col("n_all") - F.col("no_symbols")).cast("long").alias("n_symbols"),
                    "l.n_dup_lines", "w.n_repeat_words", "l.n_lines",
                    (F.col("n_all") - F.col("no_capitals")).cast("long").alias("n_capitals"))
            .withColumn("base_failed", (F.col("n_words") < 10)
                        | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def transformed(rows: DataFrame) -> DataFrame:
    """The feature vector: logarithms of ratios, damped for short texts."""
    def share(part: str, of: str, each: int) -> Column:
        return F.log(1 + 20 * F.col(part) / (F.col(of) + each))

    n = F.col("n_words")
    return rows.withColumns({
        "f0": F.log((F.col("word_chars") + 150) / (n + 25)),
        "f1": share("n_symbols", "n_words", 20), "f2": share("n_capitals", "word_chars", 100),
        "f3": share("n_dup_lines", "n_lines", 5), "f4": share("n_repeat_words", "n_words", 20)})


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _root(estimate: DataFrame, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """The Cholesky factor l_ij of the covariance c_ij (with the floor on its diagonal) in its place."""
    for i, j in _pairs():
        c = F.col(f"c{i}{j}") + (F.lit(floor[i] ** 2) if i == j else F.lit(0.0))
        for k in range(j):
            c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-9))) if i == j else c / F.col(f"l{j}{j}"))
    return estimate.drop(*[f"c{i}{j}" for i, j in _pairs()])


def _beside(rows: DataFrame, per_group: DataFrame, *on: str) -> DataFrame:
    """``rows`` with what ``per_group`` (stored) has of their group. Up to
    ``BROADCAST_GROUPS`` groups, counted here, that table goes to the rows; beyond,
    the join is left to adaptive execution, which splits a hot group."""
    few = per_group.count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(per_group) if few else per_group, list(on) or ["group"])


def _measured(rows: DataFrame, estimate: DataFrame, *keep: str) -> DataFrame:
    """Adds d2, the squared distance of each row by its group's estimate (by each, if there are several)."""
    out = _beside(rows, estimate)
    for i, f in enumerate(FEATURES):
        y = F.col(f) - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, len(FEATURES))), F.col("y0") * F.col("y0"))
    return out.select(*rows.columns, *keep, F.round(d2, 3).alias("d2"))


def _quantile(col: str | Column, at: float) -> Column:
    return F.percentile(F.round(col, 3), F.lit(at))


def _log(d2: str) -> Column:
    return F.log(1 + F.col(d2))


def _starts(rows: DataFrame) -> DataFrame:
    """(group, n, start, m_i, l_ij): the estimates that concentration begins with."""
    spark = rows.sparkSession
    middle = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"),
                                       *[_quantile(f, 0.5).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    middle = stored(spark, middle, "mcd-middle")
    spread = _beside(rows, middle).groupBy("group").agg(*[
        (1.4826 * _quantile(F.abs(F.col(f) - F.col(f"m{i}")), 0.5)).alias(f"s{i}") for i, f in enumerate(FEATURES)])
    spread = stored(spark, middle.join(spread, "group"), "mcd-spread")
    out = _beside(rows, spread)
    for i, f in enumerate(FEATURES):
        out = out.withColumn(f"y{i}", (F.col(f) - F.col(f"m{i}")) / F.sqrt(F.col(f"s{i}") * F.col(f"s{i}") + FLOOR[i] ** 2))
    norm2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, len(FEATURES))), F.col("y0") * F.col("y0"))
    out = out.withColumn("norm2", F.greatest(norm2, F.lit(1e-9)))
    moments = out.groupBy("group").agg(*[
        made for i, j in _pairs() for made in (
            F.avg(F.tanh(f"y{i}") * F.tanh(f"y{j}")).alias(f"t{i}{j}"),
            F.avg(F.col(f"y{i}") * F.col(f"y{j}") / F.col("norm2")).alias(f"u{i}{j}"))])
    known = stored(spark, spread.join(moments, "group"), "mcd-moments")

    def scatter(kind: str | None, i: int, j: int) -> Column:
        both = F.col(f"s{i}") * F.col(f"s{j}")
        if kind is None or i == j:
            return both if i == j else F.lit(0.0)
        own = F.col(f"{kind}{i}{i}") * F.col(f"{kind}{j}{j}")
        return F.when(own > 1e-12, both * F.col(f"{kind}{i}{j}") / F.sqrt(own)).otherwise(F.lit(0.0))

    begun = [known.select("group", "n", F.lit(k).alias("start"), *[f"m{i}" for i in range(len(FEATURES))],
                          *[scatter(kind, i, j).alias(f"c{i}{j}") for i, j in _pairs()])
             for k, kind in enumerate((None, "t", "u"))]
    return stored(spark, _root(begun[0].unionByName(begun[1]).unionByName(begun[2])), "mcd-start")


def estimates(rows: DataFrame) -> DataFrame:
    """Number of rows, centre, Cholesky factor and scale of each group of ``rows`` (group, f0...), stored."""
    spark = rows.sparkSession
    estimate = _starts(rows)
    counts = estimate.where("start = 0").select("group", "n")
    for _ in range(STEPS):
        measured = _measured(rows, estimate, "start")
        near = measured.groupBy("group", "start").agg(_quantile(_log("d2"), SHARE).alias("near"))
        near = stored(spark, near, "mcd-near")
        inner = _beside(measured, near, "group", "start").where(F.round(_log("d2"), 3) <= F.col("near"))
        moments = inner.groupBy("group", "start").agg(
            *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)],
            *[F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i, j in _pairs()])
        moments = moments.withColumns({f"c{i}{j}": F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")
                                       for i, j in _pairs()}).drop(*[f"s{i}{j}" for i, j in _pairs()])
        estimate = stored(spark, _root(moments), "mcd-step")
    # half the logarithm of the determinant, rounded so that starts that met in one estimate are ties
    size = F.round(sum((F.log(f"l{i}{i}") for i in range(1, len(FEATURES))), F.log("l00")), 6)
    numbers = [f"m{i}" for i in range(len(FEATURES))] + [f"l{i}{j}" for i, j in _pairs()]
    least = estimate.groupBy("group").agg(F.min(F.struct(size.alias("size"), "start", *numbers)).alias("e"))
    least = stored(spark, least.select("group", *[f"e.{x}" for x in numbers]), "mcd-least")
    scale = _measured(rows, least).groupBy("group").agg(
        F.greatest(F.lit(1.0), F.exp(_quantile(_log("d2"), 0.5)) - 1).alias("middle_d2"))
    return stored(spark, least.join(scale, "group").join(counts, "group"), "mcd")


def _mixed(names: DataFrame, found: DataFrame) -> DataFrame:
    """(group, m_i, l_ij) for each of ``names`` (own, lang): its estimate of ``found``
    mixed with those of the levels above it."""
    centre = [f"m{i}" for i in range(len(FEATURES))]
    scatter = [sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(1, j + 1)), F.col(f"l{i}0") * F.col(f"l{j}0"))
               * F.col("middle_d2") / CHI2_MEDIAN for i, j in _pairs()]
    known = found.select("group", F.col("n") / (F.col("n") + GROUP_ROWS), *centre, *scatter)
    numbers = centre + [f"c{i}{j}" for i, j in _pairs()]
    top = known.toDF("group", "share", *numbers).where("group = 'all'").first()  # one row, whatever the input
    out = names
    for level in ("own", "lang"):
        out = out.join(known.toDF(level, f"{level}_share", *[f"{level}_{x}" for x in numbers]), level, "left")

    def upon(level: str, x: str, above: Column) -> Column:  # a group without sound rows has no estimate
        share = F.col(f"{level}_share")
        return F.coalesce(share * F.col(f"{level}_{x}") + (1 - share) * above, above)

    out = out.select(F.col("own").alias("group"),
                     *[upon("own", x, upon("lang", x, F.lit(top[x]))).alias(x) for x in numbers])
    return stored(names.sparkSession, _root(out, (0.0,) * len(FEATURES)), "mcd-mixed")


def judged(docs: DataFrame, *keep: str) -> DataFrame:
    """Every row of ``docs`` with its statistics, ``base_failed``, ``d2`` (scaled) and ``kept``."""
    spark = docs.sparkSession
    rows = stored(spark, transformed(statistics(docs, *keep)), "statistics")
    lang = F.concat_ws("\x00", F.lit("lang"), F.coalesce("lang", F.lit("\x01")))
    own = F.concat_ws("\x00", F.lit("own"), F.coalesce("lang", F.lit("\x01")), F.coalesce("source", F.lit("\x01")))
    sound = rows.where(~F.col("base_failed")).select(F.explode(F.array(own, lang, F.lit("all"))).alias("group"), *FEATURES)
    found = estimates(sound)
    grouped = rows.withColumn("group", own)
    if found.isEmpty():  # no sound row at all: every row has failed the base rule
        measured = grouped.withColumn("d2", F.lit(0.0))
    else:
        names = rows.select(own.alias("own"), lang.alias("lang")).distinct()
        measured = _measured(grouped, _mixed(names, found))
    return measured.withColumn("kept", ~F.col("base_failed") & (F.col("d2") <= CUTOFF))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns (carried as one, so that no name clashes)."""
    whole = docs.select("doc_id", "lang", "source", "text", F.struct(*docs.columns).alias("__row"))
    return judged(whole, "__row").where("kept").select("__row.*")


def duckdb_sql() -> str:
    """The same for DuckDB, over a table ``documents``."""
    n, pairs = len(FEATURES), _pairs()
    features = ", ".join(FEATURES)
    space = "[ \\t\\n\\x0b\\f\\r]"

    def measured(name: str, rows: str, estimate: str) -> str:
        """CTEs that solve y = L^-1 (x - m) one coordinate after the other."""
        out, last = [], f"SELECT r.*, e.* EXCLUDE (grp) FROM {rows} r JOIN {estimate} e USING (grp)"
        for i in range(n):
            y = " - ".join([f"f{i} - m{i}", *[f"l{i}{j} * y{j}" for j in range(i)]])
            out.append(f"{name}_{i} AS MATERIALIZED (SELECT *, ({y}) / l{i}{i} AS y{i} FROM ({last}))")
            last = f"SELECT * FROM {name}_{i}"
        out.append(f"{name} AS MATERIALIZED (SELECT *, round({' + '.join(f'y{i} * y{i}' for i in range(n))}, 3) AS d2 "
                   f"FROM {name}_{n - 1})")
        return ",\n".join(out)

    def root(name: str, source: str, key: str = "grp, start", floor: tuple[float, ...] = FLOOR) -> str:
        out, last = [], source
        for i, j in pairs:
            c = " - ".join([f"c{i}{j}" + (f" + {floor[i] ** 2!r}" if i == j else ""),
                            *[f"l{i}{k} * l{j}{k}" for k in range(j)]])
            value = f"sqrt(greatest({c}, 1e-9))" if i == j else f"({c}) / l{j}{j}"
            out.append(f"{name}_{i}{j} AS MATERIALIZED (SELECT *, {value} AS l{i}{j} FROM {last})")
            last = f"{name}_{i}{j}"
        keep = ", ".join([*[f"m{i}" for i in range(n)], *[f"l{i}{j}" for i, j in pairs]])
        out.append(f"{name} AS MATERIALIZED (SELECT {key}, {keep} FROM {last})")
        return ",\n".join(out)

    def start(k: int, kind: str) -> str:
        def c(i: int, j: int) -> str:
            if i == j or not kind:
                return f"s{i} * s{j}" if i == j else "0.0::DOUBLE"
            own = f"{kind}{i}{i} * {kind}{j}{j}"
            return f"CASE WHEN {own} > 1e-12 THEN s{i} * s{j} * {kind}{i}{j} / sqrt({own}) ELSE 0 END"
        return f"SELECT grp, {k} AS start, {ms}, {', '.join(f'{c(i, j)} AS c{i}{j}' for i, j in pairs)} FROM moments"

    def upon(level: str, x: str, above: str) -> str:
        return f"coalesce({level}.share * {level}.{x} + (1 - {level}.share) * {above}, {above})"

    ms = ", ".join(f"m{i}" for i in range(n))
    numbers = [*[f"m{i}" for i in range(n)], *[f"c{i}{j}" for i, j in pairs]]
    blend = ", ".join(f"{upon('o', x, upon('l', x, f'a.{x}'))} AS {x}" for x in numbers)
    share = lambda part, of, each: f"ln(1 + 20 * {part} / ({of} + {each}))"
    ctes = [f"""t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(text, '{space}+'), lambda x: x <> '') AS words,
              list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS lines FROM t),
        g AS (SELECT rid, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g FROM
              (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
        c AS (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) AS i FROM
              (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
        s AS (SELECT rid, doc_id, lang, source, len(words) AS n_words,
              length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
              length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
              len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
              len(lines) AS n_lines, length(text) - length(translate(text, '{CAPITALS}', '')) AS n_capitals
              FROM w LEFT JOIN (SELECT rid, count(*) AS n_repeat_words FROM c GROUP BY 1) USING (rid)),
        x AS MATERIALIZED (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
              ln((word_chars + 150) / (n_words + 25)) AS f0, {share('n_symbols', 'n_words', 20)} AS f1,
              {share('n_capitals', 'word_chars', 100)} AS f2, {share('n_dup_lines', 'n_lines', 5)} AS f3,
              {share('n_repeat_words', 'n_words', 20)} AS f4,
              'own' || coalesce(lang, chr(1)) || chr(2) || coalesce(source, chr(1)) AS own,
              'lang' || coalesce(lang, chr(1)) AS tongue FROM s),
        rows_ AS MATERIALIZED (SELECT unnest([own, tongue, 'all']) AS grp, {features} FROM x WHERE NOT base_failed),
        middle AS MATERIALIZED (SELECT grp, count(*) AS n, {', '.join(
            f'quantile_cont(round(f{i}, 3), 0.5) AS m{i}' for i in range(n))} FROM rows_ GROUP BY 1),
        spread AS MATERIALIZED (SELECT grp, {', '.join(f'any_value(m{i}) AS m{i}' for i in range(n))}, {', '.join(
            f'1.4826 * quantile_cont(round(abs(f{i} - m{i}), 3), 0.5) AS s{i}' for i in range(n))}
              FROM rows_ JOIN middle USING (grp) GROUP BY 1),
        unit AS MATERIALIZED (SELECT grp, {', '.join(
            f'(f{i} - m{i}) / sqrt(s{i} * s{i} + {FLOOR[i] ** 2!r}) AS y{i}' for i in range(n))}
              FROM rows_ JOIN spread USING (grp)),
        signs AS (SELECT *, greatest({' + '.join(f'y{i} * y{i}' for i in range(n))}, 1e-9) AS norm2 FROM unit),
        moments AS MATERIALIZED (SELECT * FROM spread JOIN (SELECT grp, {', '.join(
            f'avg(tanh(y{i}) * tanh(y{j})) AS t{i}{j}, avg(y{i} * y{j} / norm2) AS u{i}{j}' for i, j in pairs)}
              FROM signs GROUP BY 1) USING (grp)),
        begun AS ({' UNION ALL '.join(start(k, kind) for k, kind in enumerate(("", "t", "u")))})""",
            root("e0", "begun")]
    for step in range(STEPS):
        k = step + 1
        ctes += [measured(f"d{k}", "rows_", f"e{step}"), f"""q{k} AS MATERIALIZED (SELECT grp, start, quantile_cont(round(ln(1 + d2), 3), {SHARE}) AS near
              FROM d{k} GROUP BY 1, 2),
        v{k} AS MATERIALIZED (SELECT grp, start, {', '.join(f'avg(f{i}) AS m{i}' for i in range(n))}, {', '.join(
            f'avg(f{i} * f{j}) - avg(f{i}) * avg(f{j}) AS c{i}{j}' for i, j in pairs)}
              FROM d{k} JOIN q{k} USING (grp, start) WHERE round(ln(1 + d2), 3) <= near GROUP BY 1, 2)""", root(f"e{k}", f"v{k}")]
    ctes += [f"""least AS MATERIALIZED (SELECT * FROM e{STEPS} QUALIFY row_number() OVER (PARTITION BY grp
              ORDER BY round({' + '.join(f'ln(l{i}{i})' for i in range(n))}, 6), start) = 1)""",
             measured("z", "rows_", "least"), f"""known AS MATERIALIZED (SELECT grp, n / (n + {GROUP_ROWS}) AS share, {ms}, {', '.join(
                 f"({' + '.join(f'l{i}{k} * l{j}{k}' for k in range(j + 1))}) * scale / {CHI2_MEDIAN} AS c{i}{j}" for i, j in pairs)}
              FROM least JOIN (SELECT grp, n FROM middle) USING (grp) JOIN
              (SELECT grp, greatest(1.0, exp(quantile_cont(round(ln(1 + d2), 3), 0.5)) - 1) AS scale FROM z GROUP BY 1) USING (grp)),
        blended AS MATERIALIZED (SELECT own AS grp, {blend} FROM (SELECT DISTINCT own, tongue FROM x)
              JOIN known a ON a.grp = 'all' LEFT JOIN known l ON l.grp = tongue LEFT JOIN known o ON o.grp = own)""",
             root("final", "blended", "grp", (0.0,) * n),
             "y AS MATERIALIZED (SELECT *, own AS grp FROM x)", measured("o", "y", "final")]
    return "WITH " + ",\n".join(ctes) + f"""
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND d2 <= {CUTOFF} AS kept FROM o"""
