"""URL filter by path-template trees, in DataFrame functions only.

Addresses first meet a list of rules. What no rule fits is judged by path templates. Every host has a
tree of its own, and one more tree holds the paths of all hosts together. A tree grows segment by
segment. Where a branch has many children, those that hold a small share of its pages are values of a
variable segment and become one wildcard, numerals and names alike. Labelled pages (those that a rule
decides) are counted at each child; children whose shares of bad pages do not differ by a
two-proportion test are merged and go on as one branch. A branch with few pages is not parted further,
so a tree ends where its pages do and has no depth of its own.

A template's purity is its share of bad pages, smoothed by that of the branch above. In a host's tree
the smoothing starts from the purity that the path has in the tree of all hosts: a host without any
labels is judged by what is known of the same template elsewhere. Pages are rejected where the purity
reaches a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import LOWER, UPPER, cut

#: A branch with more children than this has a variable segment: children with less than one part in
#: so many of its pages become the wildcard. No branch keeps more than so many literal children.
CHILDREN = 20
#: A branch with fewer pages is not parted further.
GROW = 10
#: Weight of the purity above, in labelled pages.
PRIOR = 5.0
#: z value from which two shares count as different.
DIFFERENT = 1.96
#: Tasks that the rows of one branch are dealt over.
SALTS = 32
#: Labelled share of bad pages that counts before any page: so many bad ones of so many.
START_BAD, START_ALL = 0.5, 2.0

#: Spelling of a wildcard in templates, and of a segment that is one asterisk.
WILD, ASTERISK = "*", "%2A"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _clusters(kids: Column) -> Column:
    """Array of (name, segs, n, b, g): `kids` (share, seg, n, b, g), at most CHILDREN and the wildcard, in
    order of their share of bad pages. A labelled child joins the cluster before it unless their shares
    differ by a two-proportion test; a child without labels stays by itself."""
    kind = "array<struct<segs:array<string>,n:bigint,b:bigint,g:bigint>>"

    def differ(c: Column, x: Column) -> Column:
        m, k = c["b"] + c["g"], x["b"] + x["g"]
        both = (c["b"] + x["b"]) / (m + k)
        z = F.abs(c["b"] / m - x["b"] / k) / F.sqrt(both * (1 - both) * (1 / m + 1 / k))
        # No spread at all: both shares are 0, or both are 1.
        return F.coalesce(F.when((both > 0) & (both < 1), z), F.lit(0.0)) >= DIFFERENT

    def step(a: Column, x: Column) -> Column:
        alone = F.struct(F.array(x["seg"]).alias("segs"), x["n"].alias("n"), x["b"].alias("b"), x["g"].alias("g"))
        last = F.element_at(a, -1)
        joined = F.struct(
            F.array_append(last["segs"], x["seg"]).alias("segs"),
            (last["n"] + x["n"]).alias("n"),
            (last["b"] + x["b"]).alias("b"),
            (last["g"] + x["g"]).alias("g"),
        )
        apart = (F.size(a) == 0) | differ(F.get(a, F.size(a) - 1), x)
        return F.when(apart, F.array_append(a, alone)).otherwise(F.array_append(F.slice(a, 1, F.size(a) - 1), joined))

    labelled = F.array_sort(F.filter(kids, lambda x: x["b"] + x["g"] > 0))
    bare = F.transform(
        F.filter(kids, lambda x: x["b"] + x["g"] == 0),
        lambda x: F.struct(F.array(x["seg"]).alias("segs"), x["n"].alias("n"), x["b"].alias("b"), x["g"].alias("g")),
    )
    made = F.concat(F.aggregate(labelled, F.array().cast(kind), step), bare)

    def named(c: Column) -> Column:
        many = F.concat(F.lit("{"), F.array_join(F.array_sort(c["segs"]), "|"), F.lit("}"))
        return F.struct(F.when(F.size(c["segs"]) > 1, many).otherwise(c["segs"][0]).alias("name"), c["segs"], c["n"], c["b"], c["g"])

    return F.transform(made, named)


def _met(rows: DataFrame, few: DataFrame, same: Column, by: str) -> DataFrame:
    """`rows` joined to `few`, which has one narrow row for a tree or a branch. Rows of a large branch are
    dealt by `by` over SALTS tasks, and each of `few` goes to all of them."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    copies = few.withColumn("f_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies.hint("merge"), same & (F.col("salt") == F.col("f_salt"))).drop("salt", "f_salt")


def branches(live: DataFrame) -> DataFrame:
    """(b_tree, b_t, clusters) of every branch of `live` (tree, t, seg, n, b, g): its children, small ones
    of a variable segment as the wildcard, similar ones merged. All counts are combined before they are
    exchanged; what is gathered in a row is at most CHILDREN literals and the wildcard."""
    sums = [F.sum(c).alias(c) for c in ("n", "b", "g")]
    kids = cut(live.groupBy("tree", "t", "seg").agg(*sums))
    whole = kids.groupBy(F.col("tree").alias("w_tree"), F.col("t").alias("w_t")).agg(
        F.count(F.lit(1)).alias("many"), F.sum("n").alias("pages")
    )
    met = _met(kids, whole, (F.col("tree") == F.col("w_tree")) & (F.col("t") == F.col("w_t")), "seg")
    small = (F.col("many") > CHILDREN) & (F.col("n") * CHILDREN < F.col("pages"))
    folded = met.withColumn("seg", F.when(small, F.lit(WILD)).otherwise(F.col("seg"))).groupBy("tree", "t", "seg").agg(*sums)
    share = ((F.col("b") + 0.5) / (F.col("b") + F.col("g") + 1)).alias("share")
    gathered = folded.groupBy(F.col("tree").alias("b_tree"), F.col("t").alias("b_t")).agg(
        F.collect_list(F.struct(share, "seg", "n", "b", "g")).alias("kids")
    )
    return gathered.select("b_tree", "b_t", _clusters(F.col("kids")).alias("clusters"))


def grown(paths: DataFrame) -> DataFrame:
    """(tree, path, t, own, above) of every row of `paths` (tree, path, n, b, g): its template, whose purity
    is own + above * x where x is the purity before any segment. One round for each segment, for as long as
    branches have pages enough; each round's rows are written before the next."""
    # Segment 0, before the first slash, stands for the whole tree.
    segs = F.transform(F.split("path", "/", -1), lambda x: F.when(x == WILD, ASTERISK).otherwise(x))
    totals = paths.groupBy(F.col("tree").alias("r_tree")).agg(*[F.sum(c).alias(f"r_{c}") for c in ("n", "b", "g")])
    rooted = _met(paths, totals, F.col("tree") == F.col("r_tree"), "path")

    def smoothed(bad: Column, good: Column, own: Column, above: Column) -> list[Column]:
        known = bad + good + PRIOR
        return [((bad + PRIOR * own) / known).alias("own"), (PRIOR * above / known).alias("above")]

    now = cut(
        rooted.select(
            "tree", "path", "n", "b", "g", segs.alias("segs"), F.lit("").alias("t"),
            *smoothed(F.col("r_b"), F.col("r_g"), F.lit(0.0), F.lit(1.0)), F.col("r_n").alias("pages"),
        )
    )
    done, level = None, 0
    while True:
        level += 1
        grows = (F.col("pages") >= GROW) & (F.size("segs") > level)
        live = now.where(grows)
        ended = now.where(~grows).select("tree", "path", "t", "own", "above")
        done = ended if done is None else done.union(ended)
        if not live.take(1):
            return done
        live = live.withColumn("seg", F.get("segs", F.lit(level)))
        met = _met(live, branches(live), (F.col("tree") == F.col("b_tree")) & (F.col("t") == F.col("b_t")), "path")
        of = lambda seg: F.get(F.filter("clusters", lambda c: F.array_contains(c["segs"], seg)), F.lit(0))
        picked = met.withColumn("c", F.coalesce(of(F.col("seg")), of(F.lit(WILD))))
        now = cut(
            picked.select(
                "tree", "path", "n", "b", "g", "segs", F.concat("t", F.lit("/"), F.col("c.name")).alias("t"),
                *smoothed(F.col("c.b"), F.col("c.g"), F.col("own"), F.col("above")), F.col("c.n").alias("pages"),
            )
        )


#: Name of the tree of all hosts; a host's tree has a slash before its name.
EVERY = ""


def template_trees(paths: DataFrame) -> DataFrame:
    """(t_host, t_path, template, purity) of the distinct `paths` (host, path, n, b, g): of the host's own
    tree, started from the tree of all hosts. All trees grow in the same rounds."""
    sums = [F.sum(c).alias(c) for c in ("n", "b", "g")]
    every = paths.groupBy("path").agg(*sums).select(F.lit(EVERY).alias("tree"), "path", "n", "b", "g")
    hosts = paths.select(F.concat(F.lit("/"), "host").alias("tree"), "path", "n", "b", "g")
    bad, good = paths.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("g"), F.lit(0))).first()
    found = cut(grown(hosts.union(every)))
    start = F.col("own") + F.col("above") * ((bad + START_BAD) / (bad + good + START_ALL))
    known = found.where(F.col("tree") == EVERY).select(F.col("path").alias("c_path"), start.alias("c_p"))
    met = found.where(F.col("tree") != EVERY).join(known.hint("merge"), F.col("path") == F.col("c_path"))
    return met.select(
        F.substring("tree", 2, 2**31 - 1).alias("t_host"),
        F.col("path").alias("t_path"),
        F.col("t").alias("template"),
        (F.col("own") + F.col("above") * F.col("c_p")).alias("purity"),
    )


def judged_urls(
    pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", reject: float = 0.7
) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule (or null), verdict (allow or block), template.

    Null addresses and those without ``://`` have empty host and path, fit no rule and belong to one
    tree. Without any labelled page nothing is rejected by the trees. Null ids stay; repeated rows
    each give a row and count each; an empty table gives an empty one; other columns are ignored. A
    branch with fewer than GROW pages is not parted, so its pages share a template.
    """
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumn("rule", rule).withColumn("ruled", verdict)
    paths = cut(
        judged.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("b"),
            F.count(F.when(F.col("ruled") == "allow", 1)).alias("g"),
        )
    )
    tree = cut(template_trees(paths))
    met = judged.join(tree.hint("merge"), (F.col("host") == F.col("t_host")) & (F.col("path") == F.col("t_path")))
    own = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    return met.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template")


def _tree_sql(name: str, source: str) -> str:
    """CTE `name` (tree, path, t, p): grown() of `source` (tree, path, n, b, g, start)."""
    row = "struct(segs varchar[], n hugeint, b hugeint, g hugeint)"
    z = """abs(c.b / (c.b + c.g) - x.b / (x.b + x.g)) / sqrt(((c.b + x.b) / (c.b + c.g + x.b + x.g)) *
      (1 - (c.b + x.b) / (c.b + c.g + x.b + x.g)) * (1 / (c.b + c.g) + 1 / (x.b + x.g)))"""
    alone = "{'segs': x.segs, 'n': x.n, 'b': x.b, 'g': x.g}"
    joined = "{'segs': list_concat(c.segs, x.segs), 'n': c.n + x.n, 'b': c.b + x.b, 'g': c.g + x.g}"
    # One list is folded: its first element holds the clusters made so far, each other one a child.
    empty = f"{{'done': []::{row}[], 'x': null::{row}}}"
    fold = f"""list_reduce(list_prepend({empty}, list_transform(kids, lambda k: {{'done': []::{row}[], 'x': k}})),
      lambda a, y: {{'done': case when len(a.done) = 0 or apart(a.done[-1], y.x) then list_append(a.done, {alone.replace("x.", "y.x.")})
        else list_append(a.done[:len(a.done) - 1], {joined.replace("c.", "a.done[-1].").replace("x.", "y.x.")}) end, 'x': null::{row}}}).done"""
    test = f"""case when c.b + x.b = 0 or c.g + x.g = 0 then false else {z} >= {DIFFERENT} end"""
    for var, value in (("c.", "a.done[-1]."), ("x.", "y.x.")):
        test = test.replace(var, value)
    fold = fold.replace("apart(a.done[-1], y.x)", f"({test})")
    return f"""{name} as (
  select 0 as level, tree, path, n, b, g, list_transform(string_split(path, '/'), lambda s: case when s = '{WILD}' then '{ASTERISK}' else s end) as segs,
    '' as t, (sum(b) over (partition by tree) + {PRIOR}::double * start) / (sum(b) over (partition by tree) + sum(g) over (partition by tree) + {PRIOR}::double) as p,
    (sum(n) over (partition by tree))::hugeint as pages
  from {source}
  union all (
  with live as (select *, segs[level + 2] as seg from {name} where pages >= {GROW} and len(segs) > level + 1),
  kids as (select tree, t, seg, sum(n) as n, sum(b) as b, sum(g) as g from live group by all),
  whole as (select tree, t, count(*) as many, sum(n) as pages from kids group by all),
  folded as (select tree, t, case when many > {CHILDREN} and n * {CHILDREN} < pages then '{WILD}' else seg end as seg, sum(n) as n, sum(b) as b, sum(g) as g
    from kids join whole using (tree, t) group by all),
  labelled as (select tree, t, list({{'segs': [seg], 'n': n::hugeint, 'b': b::hugeint, 'g': g::hugeint}} order by (b + 0.5::double) / (b + g + 1), seg) as kids
    from folded where b + g > 0 group by all),
  made as (select tree, t, unnest({fold}) as c from labelled
    union all select tree, t, {{'segs': [seg], 'n': n::hugeint, 'b': b::hugeint, 'g': g::hugeint}} from folded where b + g = 0),
  named as (select tree, t, c, unnest(c.segs) as seg,
    case when len(c.segs) > 1 then '{{' || array_to_string(list_sort(c.segs), '|') || '}}' else c.segs[1] end as label from made)
  select live.level + 1, live.tree, live.path, live.n, live.b, live.g, live.segs, live.t || '/' || coalesce(own.label, wild.label),
    (coalesce(own.c, wild.c).b + {PRIOR}::double * live.p) / (coalesce(own.c, wild.c).b + coalesce(own.c, wild.c).g + {PRIOR}::double), coalesce(own.c, wild.c).n
  from live left join named own on own.tree = live.tree and own.t = live.t and own.seg = live.seg
    left join named wild on wild.tree = live.tree and wild.t = live.t and wild.seg = '{WILD}')),
{name}_end as (select tree, path, arg_max(t, level) as t, arg_max(p, level) as p from {name} group by all)"""


def url_filter_sql(rules: Sequence[Rule], reject: float = 0.7) -> str:
    """The same judgement as DuckDB SQL over a view `pages`."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def fits(r: Rule) -> str:
        return f"((host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}'))"

    text = " ".join(f"when {fits(r)} then '{r.text}'" for r in order)
    verdict = " ".join(f"when {fits(r)} then '{r.verdict}'" for r in order)
    return f"""with recursive parts as (select page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
judged as (select *, case {text} end as rule, case {verdict} end as ruled from parts),
paths as (select host, path, count(*) as n, count(*) filter (ruled = 'block') as b, count(*) filter (ruled = 'allow') as g from judged group by all),
every as (select '' as tree, path, sum(n) as n, sum(b) as b, sum(g) as g,
  (select (sum(b) + {START_BAD}::double) / (sum(b) + sum(g) + {START_ALL}::double) from paths) as start from paths group by path),
{_tree_sql("common", "every")},
own as (select host as tree, path, n, b, g, p as start from paths join common_end using (path)),
{_tree_sql("hosts", "own")}
select j.page_id, j.host, j.path, j.rule, coalesce(j.ruled, case when h.p >= {reject} then 'block' else 'allow' end) as verdict, h.t as template
from judged j join hosts_end h on j.host = h.tree and j.path = h.path"""
