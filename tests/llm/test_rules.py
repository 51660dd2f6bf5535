"""Quality rules, URL templates and toxicity against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import quality_rules, toxicity, url_templates
from quarry.llm.queries import URL_RULES
from quarry.llm.common import mixed


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            inside |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside),
            len(w) < 10 or 100 * len(inside) > 20 * len(w))


def test_statistics(odd, documents):
    for docs in (odd, documents):
        got = quality_rules.judged(docs).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                        r["n_repeat_words"], r["base_failed"]) for r in got) \
            == Counter((r["doc_id"], *base(r["text"] or "")) for r in docs.select("doc_id", "text").collect())
        assert not any(r["kept"] and r["base_failed"] for r in got)


def mcd(x):
    """The same estimate in numpy: centre, scatter scaled to chi-square, and the determinants of the three starts."""
    quantile = lambda v, q: np.quantile(np.floor(v * 1000 + 0.5) / 1000, q)
    floor = np.diag(np.array(quality_rules.FLOOR) ** 2)
    middle = np.array([quantile(c, 0.5) for c in x.T])
    mad = np.array([1.4826 * quantile(np.abs(c), 0.5) for c in (x - middle).T])
    y = (x - middle) / np.sqrt(mad ** 2 + np.diag(floor))

    def distance(mean, cov):
        d = x - mean
        return np.round((d @ np.linalg.inv(cov + floor) * d).sum(axis=1), 3)

    def correlation(t):
        s = t.T @ t / len(t)
        own = np.outer(np.diag(s), np.diag(s))
        out = np.where(own > 1e-12, s / np.sqrt(np.maximum(own, 1e-12)), 0.0)
        np.fill_diagonal(out, 1.0)
        return out

    signs = y / np.sqrt(np.maximum((y * y).sum(axis=1, keepdims=True), 1e-9))
    ends = []
    for r in (np.eye(x.shape[1]), correlation(np.tanh(y)), correlation(signs)):
        mean, cov = middle, np.outer(mad, mad) * r
        for _ in range(quality_rules.STEPS):
            log = np.log(1 + distance(mean, cov))
            inner = x[np.floor(log * 1000 + 0.5) / 1000 <= quantile(log, quality_rules.SHARE) + 1e-9]
            mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True).reshape(x.shape[1], -1)
        ends.append((round(np.linalg.slogdet(cov + floor)[1] / 2, 6), len(ends), mean, cov))
    _, _, mean, cov = min(ends, key=lambda e: e[:2])
    scale = max(1.0, np.exp(quantile(np.log(1 + distance(mean, cov)), 0.5)) - 1) / quality_rules.CHI2_MEDIAN
    return mean, (cov + floor) * scale, [e[0] for e in ends]


def test_distances_against_numpy(spark):
    """Large and small groups, each mixed with its language and all rows; null languages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumns({"lang": F.when(F.col("lang") == "en", "en").when(F.col("lang") != "de", "xx"),
                             "source": F.when(F.col("doc_id") % 9 == 0, "small").otherwise("large")})
    rows = quality_rules.transformed(quality_rules.statistics(docs)).toPandas().set_index("doc_id")
    got = quality_rules.judged(docs).toPandas().set_index("doc_id")
    rows["lang"] = rows.lang.fillna("none")
    sound = rows[~rows.base_failed]

    def estimate(own):
        mean, cov, _ = mcd(own[list(quality_rules.FEATURES)].to_numpy())
        return len(own) / (len(own) + quality_rules.GROUP_ROWS), mean, cov

    _, all_mean, all_cov = estimate(sound)
    for lang, of_lang in rows.groupby("lang"):
        w, mean, cov = estimate(sound[sound.lang == lang])
        lang_mean, lang_cov = w * mean + (1 - w) * all_mean, w * cov + (1 - w) * all_cov
        for source, own in of_lang.groupby("source"):
            w, mean, cov = estimate(sound[(sound.lang == lang) & (sound.source == source)])
            d = own[list(quality_rules.FEATURES)].to_numpy() - (w * mean + (1 - w) * lang_mean)
            want = (d @ np.linalg.inv(w * cov + (1 - w) * lang_cov) * d).sum(axis=1)
            assert np.allclose(got.loc[own.index].d2.to_numpy(), want, rtol=0.02, atol=0.02)


def test_least_determinant_of_the_starts_wins(spark):
    """Correlated features with a fifth of far rows: the starts end apart, and the least one is taken."""
    r = np.random.default_rng(3)
    k = len(quality_rules.FEATURES)
    seen = 0
    for _ in range(3):
        x = r.normal(size=(60, k)) @ r.normal(size=(k, k)) * 2
        x[:14] = r.normal(size=(14, k)) * 0.3 + r.normal(size=k) * 6
        found = quality_rules.estimates(spark.createDataFrame(
            [("g", *map(float, row)) for row in x], "group string, " + ", ".join(f"{f} double" for f in quality_rules.FEATURES)))
        e = found.first().asDict()
        low = np.array([[e[f"l{i}{j}"] if j <= i else 0.0 for j in range(k)] for i in range(k)])
        mean, cov, sizes = mcd(x)
        assert abs(np.log(np.diag(low)).sum() - min(sizes)) < 1e-4 and e["n"] == 60
        assert np.allclose(low @ low.T * e["middle_d2"] / quality_rules.CHI2_MEDIAN, cov, rtol=1e-3, atol=1e-3)
        seen += sizes[0] > min(sizes) + 1e-3
    assert seen  # another start than the first was better


def test_outliers_go_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality_rules.judged(docs).join(labels, "doc_id").where(~F.col("base_failed"))
    kept = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
            .collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_quality_kept_rows(odd, empty):
    kept = quality_rules.kept_rows(odd)
    assert kept.columns == odd.columns
    assert all(not base(r["text"] or "")[5] for r in kept.collect())
    assert quality_rules.judged(empty).count() == 0


# --- urls --------------------------------------------------------------------------------


def url_brute(urls):
    rows = []
    for u in urls:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1], m[2]) if m else ("", "")
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, ruling = max(fits) if fits else (0, None, None)
        rows.append([host, path, rule, ruling])
    template, purity = {}, {}

    def leaf(paths, name):
        template.update(dict.fromkeys(paths, name))
        labels = [ruling for ruling in paths.values() if ruling]
        return name, labels.count("allow"), len(labels), True, []

    def grow(name, paths, d):
        """(template or None, allowed, labelled, whether all of it agrees, its branches)."""
        below = defaultdict(dict)
        ends = {k: v for k, v in paths.items() if len(segs(k)) == d}
        rest = {k: v for k, v in paths.items() if len(segs(k)) > d}
        share = Counter(segs(k)[d] for k in rest)
        for k, v in rest.items():
            s = segs(k)[d]
            below[s if share[s] * url_templates.LITERAL_ONE_IN >= len(rest) else "*"][k] = v
        kids = [leaf(ends, name)] if ends else []
        kids += [grow(f"{name}/{s}", part, d + 1) for s, part in below.items()]
        known = [k for k in kids if k[2]]
        a, n = sum(k[1] for k in known), sum(k[2] for k in known)
        rate = (a + 1) / (n + 2)
        like = [k for k in known if abs(k[1] / k[2] - rate) <= url_templates.SIMILAR * math.sqrt(rate * (1 - rate) / k[2])]
        merged = [k for k in like if k[3]]
        judge(merged, sum(k[1] for k in merged), sum(k[2] for k in merged))
        return None, a, n, len(like) == len(known) and all(k[3] for k in known), kids

    def judge(branches, a, n):
        for k in branches:
            if k[0] is not None and k[2]:
                purity[k[0]] = (a + 1) / (n + 2)
            judge([b for b in k[4] if b[2]], a, n)

    segs = lambda k: k[1][1:].split("/")
    by_host = defaultdict(dict)
    for host, path, _, ruling in rows:
        by_host[host][host, path] = ruling
    for host, paths in by_host.items():
        grow(host, paths, 0)
    for k, t in template.items():
        if t not in purity:
            same = [v for q, v in by_host[k[0]].items() if template[q] == t and v]
            purity[t] = (same.count("allow") + 1) / (len(same) + 2)
    templates = [template[r[0], r[1]] for r in rows]
    return Counter((r[0], r[1], r[2], r[3] or ("block" if purity[t] < url_templates.PURITY else "allow"), t)
                   for r, t in zip(rows, templates))


def test_url_templates(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    more = [(None, None), (1, ""), (2, "no scheme"), (3, "http://"), (3, "http://"), (4, "HTTP://EXAMPLE.Net/es/x?q#f"),
            (5, "http://a.net#f"), (6, "http://b.net?q=/es/"), (7, "http://c.org/" + "/".join("abcdefgh")),
            (7, "http://c.org/" + "/".join("abcdefgx")), (7, "http://c.org/a/b"), (7, "http://d.net/es/" + "long/" * 200 + "x" * 100000),
            (8, "x\ny://d.com/p"), (9, "http://notcom/x"), (10, "http://xcom/"), (11, "http://É.net/es/")]
    more += [(100 + i, f"http://h.net/{'es' if i % 2 else 'zz'}/{i}") for i in range(60)]
    every = pages.unionByName(spark.createDataFrame(more, "page_id long, url string"))
    every = every.withColumns({n: F.lit("own") for n in ("host", "path", "rule", "template", "node0", "segments", "purity")})
    got = url_templates.judged(every, URL_RULES).collect()
    assert Counter((r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in got) \
        == url_brute([r["url"] for r in every.collect()])
    assert Counter(r["page_id"] for r in got) == Counter(r["page_id"] for r in every.collect())
    none = url_templates.judged(every.limit(0), URL_RULES)
    assert none.count() == 0


def test_repeated_rows_leave_every_verdict(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    once = {(r["host"], r["path"]): (r["verdict"], r["template"]) for r in url_templates.judged(pages, URL_RULES).collect()}
    again = pages.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    assert {(r["host"], r["path"]): (r["verdict"], r["template"])
            for r in url_templates.judged(again, URL_RULES).collect()} == once


def test_purity_rejects_a_template(spark):
    """Variable segments of which rules block nearly all: the rest goes with them."""
    urls = [f"http://h.org/a/{k}" for k in range(200)]
    rules = [("h.org", f"/a/{k}", "block") for k in range(20, 100)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    verdicts = Counter((r["rule"] is None, r["verdict"]) for r in url_templates.judged(df, rules).collect())
    assert verdicts[True, "block"] > 0 and verdicts[True, "allow"] == 0


def test_subtrees_merge(spark):
    """Branches that agree are judged together, those that differ alone, at any depth."""
    urls = [f"http://h.org/deep/er/s{s}/{'xy'[k % 2]}{k}" for s in range(4) for k in range(100)]
    urls += [f"http://h.org/fine/{'xy'[k % 2]}{k}" for k in range(100)]
    rules = [("h.org", f"/deep/er/s{s}/x", "allow" if s == 3 else "block") for s in range(4)]
    rules += [("h.org", "/fine/x", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_templates.judged(pages, rules).where("rule IS NULL").collect()
    verdicts = {r["template"]: (r["verdict"], round(r["purity"], 4)) for r in got}
    assert verdicts["h.org/deep/er/s3/*"][0] == verdicts["h.org/fine/*"][0] == "allow"
    assert {verdicts[f"h.org/deep/er/s{s}/*"][0] for s in range(3)} == {"block"}
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(f"SELECT page_id, template, verdict, purity FROM ({url_templates.duckdb_sql(rules)})").fetchall()
    have = url_templates.judged(pages, rules).select("page_id", "template", "verdict", "purity").collect()
    assert sorted(want) == sorted(map(tuple, have))


# --- toxicity ----------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    x = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    toxic, clean = x[x.toxic == 1], x[x.toxic == 0]
    auc = (toxic.score.to_numpy()[:, None] > clean.score.to_numpy()[None, :]).mean()
    assert auc > 0.97 and clean.predicted.mean() < 0.01 and toxic.predicted.mean() > 0.7


def toxic_features(text):
    """Words, stems, neighbour pairs and skip pairs as bytes, before any hash."""
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    w = re.findall(rb"[0-9a-z\x80-\xff]+", lowered)
    return ({("word", x) for x in w} | {("stem", x[:toxicity.STEM]) for x in w if len(x) > toxicity.STEM}
            | {("pair", *x) for x in zip(w, w[1:], strict=False)} | {("skip", *x) for x in zip(w, w[2:], strict=False)})


def test_toxicity_features_against_brute_force():
    """Equal features get equal numbers in every text, and different ones hardly ever the same."""
    texts = ["", "A a", "Gr\u00fc\u00dfe, gr\u00fc\u00dfe!  WORDS wordsworth words2", "one two three one two", "x" * 5000 + " end",
             *[" ".join(f"w{k * j % 97}" for j in range(k)) for k in range(60)]]
    raw, starts = toxicity.text_bytes(pa.array(texts))
    row, feature = toxicity.features(raw, starts)
    got = [set(feature[row == k].tolist()) for k in range(len(texts))]
    want = [toxic_features(t) for t in texts]
    everything = set().union(*want)
    assert len(set().union(*got)) >= 0.98 * len(everything)
    for a in range(len(texts)):
        assert len(want[a]) * 0.98 <= len(got[a]) <= len(want[a])
        for b in range(a):
            assert len(want[a] & want[b]) <= len(got[a] & got[b]) <= len(want[a] & want[b]) + 0.05 * len(want[a]) + 3


def test_ftrl_steps_against_one_coordinate_at_a_time():
    r = np.random.default_rng(11)
    model, z, n = toxicity.Ftrl(alpha=0.7, beta=0.9, l1=0.4, l2=0.2), Counter(), Counter()
    end = 1 << toxicity.BITS

    def weight(i):
        l1 = 0.0 if i == end else 0.4
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((0.9 + math.sqrt(n[i])) / 0.7 + 0.2)

    for _ in range(300):
        at, label = sorted(set(r.integers(0, 40, 8).tolist())), int(r.integers(0, 2))
        model.learn(np.array(at, np.int32), label)
        w = {i: weight(i) for i in [*at, end]}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i, own in w.items():
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.7 * own
            n[i] += g * g
    got = model.weights(slice(None))
    assert np.allclose([got[i] for i in [*range(40), end]], [weight(i) for i in [*range(40), end]], atol=1e-9)
    assert not got[40:end].any() and any(weight(i) == 0.0 for i in range(40)) and any(weight(i) for i in range(40))


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, None, 0), (None, 1, 1), (4, 0, 1), (4, 0, 0), (9, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in odd.collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    nothing = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert all(r["score"] < 0.5 for r in nothing)
    assert toxicity.toxicity(empty, labels).count() == 0


def test_ftrl_learns_a_word():
    model = toxicity.Ftrl()
    r = np.random.default_rng(1)
    for _ in range(3):
        for i in range(400):
            model.learn(np.append(r.integers(100, 5000, 30), 7 if i % 2 else 8), i % 2)
    w = model.weights(slice(None))
    assert w[7] > 1 > 0 > w[8] and (w != 0).sum() < 1000
    assert mixed(np.zeros(1, np.uint64)).dtype == np.uint64
