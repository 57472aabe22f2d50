"""Path templates and their purity against a tree built node by node."""

from __future__ import annotations

import math
import random
import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from tarnlake.llm import url_templates


def _templates(urls, many=12, share=0.05):
    """Template of each distinct (host, path)."""
    count = defaultdict(int)
    for host, path in urls:
        count[(host, path)] += 1
    out = {k: () for k in count}
    rest = {k: [p for p in k[1].split("/") if p] for k in count}
    for level in range(max(map(len, rest.values()), default=0)):
        below = defaultdict(lambda: defaultdict(int))
        for k, n in count.items():
            if level < len(rest[k]):
                below[(k[0], out[k])][rest[k][level]] += n
        for k in count:
            if level < len(rest[k]):
                part, own = rest[k][level], below[(k[0], out[k])]
                stem = re.sub(r"\.[A-Za-z]{2,5}$", "", part)
                wild = 2 * len(re.sub("[^0-9]", "", stem)) > len(stem)
                wild |= len(own) >= many and own[part] < share * sum(own.values())
                rest[k][level] = "*" if wild else part
        for k in count:
            if level < len(rest[k]):
                out[k] = (*out[k], rest[k][level])
    return out


def _purity(sums, strength=4.0, z=1.96):
    """Purity of each (host, template), going down with united branches."""
    smooth = lambda g, b, p: (g + strength * p) / (g + b + strength)
    total = [sum(v[i] for v in sums.values()) for i in (0, 1)]
    prior = (total[0] + 1) / (sum(total) + 2)
    out = {}
    for host in {h for h, _ in sums}:
        mine = {t: v for (h, t), v in sums.items() if h == host}

        def down(members, level, above, host=host, mine=mine):
            parts = defaultdict(list)
            for t in members:
                if len(t) == level:
                    out[(host, t)] = above
                else:
                    parts[t[level]].append(t)
            counts = {p: tuple(sum(mine[t][i] for t in ts) for i in (0, 1)) for p, ts in parts.items()}
            equal = defaultdict(list)
            for p, c in counts.items():
                equal[c].append(p)
            rows = sorted((g / (g + b), (g + b) * len(ps), g, g * len(ps), ps) for (g, b), ps in equal.items() if g + b)
            groups, last = [], None
            for rate, n, _, g, ps in rows:
                if last is None:
                    groups.append([])
                else:
                    pooled = (g + last[1]) / (n + last[0])
                    if rate - last[1] / last[0] > z * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / last[0])):
                        groups.append([])
                groups[-1].extend(ps)
                last = (n, g)
            groups.append([p for c, ps in equal.items() if not sum(c) for p in ps])
            for group in groups:
                if group:
                    g, b = (sum(counts[p][i] for p in group) for i in (0, 1))
                    down([t for p in group for t in parts[p]], level + 1, smooth(g, b, above))

        g, b = (sum(v[i] for v in mine.values()) for i in (0, 1))
        down(list(mine), 0, smooth(g, b, prior))
    return out


def _urls(seed, count=700):
    rng = random.Random(seed)
    sections = {"blog": 0.9, "news": 0.85, "ads": 0.1, "win": 0.15, "x": 0.5}
    rows = []
    for i in range(count):
        host = rng.choice(["a.com", "a.com", "b.org", "", "c.net"])
        section = rng.choice([*sections, "", f"only{i}"])
        tail = rng.choice(["", "/index.html", f"/{i}", f"/page-{rng.randrange(40)}", "/deep/er/still/more", f"/deep/er/{i}/z"])
        good = rng.random() < sections.get(section, 0.5) if rng.random() < 0.6 else None
        rows.append((i, host, f"/{section}{tail}", good))
    return rows + [(count, "a.com", "//blog///7", None), (count + 1, "a.com", "/blog", True), (count + 1, "a.com", "/blog", True)]


def test_templates_and_purity_equal_the_tree(spark):
    rows = _urls(1)
    frame = spark.createDataFrame([(h, p) for _, h, p, _ in rows], "host string, path string")
    want = _templates([(h, p) for _, h, p, _ in rows])
    got = url_templates.path_templates(frame).collect()
    assert {(r.host, r.path): tuple(r.template) for r in got} == want and len(got) == len(want)
    sums = defaultdict(lambda: [0, 0])
    for _, host, path, good in rows:
        pair = sums[(host, want[(host, path)])]
        if good is not None:
            pair[0 if good else 1] += 1
    labelled = spark.createDataFrame([(h, list(t), g, b) for (h, t), (g, b) in sums.items()],
                                     "host string, template array<string>, good long, bad long")
    purity = {(r.host, tuple(r.template)): r.purity for r in url_templates.template_purity(labelled).collect()}
    expected = _purity(sums)
    assert purity.keys() == expected.keys()
    assert all(abs(purity[k] - expected[k]) < 1e-9 for k in expected)


def test_verdicts_follow_the_purity(spark):
    rows = _urls(5, 300)
    pages = spark.createDataFrame([(i, f"http://{h}{p}" if h else p, "t") for i, h, p, _ in rows], "page_id long, url string, template string")
    labels = spark.createDataFrame([(i, g) for i, _, _, g in rows], "page_id long, good boolean")
    got = url_templates.judge_urls(pages, labels=labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.verdict == ("block" if r.purity < 0.4 else "allow")


def test_a_very_long_path_costs_no_more_passes(spark):
    short = [(i, f"http://h.com/{'ab'[i % 2]}/{i}") for i in range(50)]
    long = [(100, "http://h.com/" + "/".join(f"s{k}" for k in range(400))), (101, "http://h.com/" + "/".join(f"s{k}" for k in range(399)) + "/z")]
    took = []
    for rows in (short, short, short + long):
        began = time.time()
        pages = spark.createDataFrame(rows, "page_id long, url string")
        labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(50)], "page_id long, good boolean")
        got = url_templates.judge_urls(pages, labels=labels).collect()
        assert len(got) == len(rows)
        took.append(time.time() - began)
    assert took[2] < 4 * took[1] + 5


def test_hot_host_and_no_labels(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://hot.com/p"), F.col("id") % 7, F.lit("/"), "id").alias("url"))
    rows = url_templates.judge_urls(pages).groupBy("template", "verdict").count().collect()
    assert {(r.template, r.verdict) for r in rows} == {(f"/p{k}/*", "allow") for k in range(7)}
