"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Each text is searched for candidate credentials of three kinds; a candidate is kept as its span
and the hash of its value. Over the whole corpus each hash is counted by rows, distinct
repositories and distinct owners. A value that several owners hold, or two owners in many
repositories, is a widely copied example; a value that one owner has in few repositories and that
looks random is taken for live. The verdict is added to the document as a
further span over the value itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import cut, wrapped


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Kind -> pattern, group of the value, least length of the value; in the order that ties are listed.
KINDS = {
    "assign": (rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: The same matches where failing ones never hide others: much faster on plain prose.
_FAST = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
#: Verdict spans, listed behind the kinds above where they start together.
VERDICTS = ("live", "example")
#: Owners, and repositories of more than one owner, from which a value counts as widely copied.
WIDE_OWNERS, WIDE_REPOS = 3, 4
ORDER = [*KINDS, *VERDICTS]

_SPAN = "struct<rank:int,start:int,stop:int,vstart:int,hash:string,random:boolean>"
#: Fragments that placeholders hold.
PLACEHOLDER = "(?i)example|sample|dummy|change_?me|placeholder|your[_-]|xxxx|1234567"


def _spans_of(text: Column, kind: str) -> Column:
    """Array of spans of one kind in `text`; positions in code points, end exclusive."""
    pattern, group, least = KINDS[kind]
    pattern = _FAST.get(kind, pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # The pieces between matches give the positions: start of match k = all pieces and matches before.
    both = F.arrays_zip(F.split(text, pattern, -1).alias("p"), whole.alias("m"), value.alias("v"))
    both = F.filter(both, lambda x: x["m"].isNotNull())
    rank = ORDER.index(kind)

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["p"])
        stop = start + F.length(x["m"])
        span = F.struct(
            F.lit(rank).alias("rank"),
            start.alias("start"),
            stop.alias("stop"),
            (stop - F.length(x["v"])).alias("vstart"),
            F.sha2(x["v"], 256).alias("hash"),
            _random(x["v"]).alias("random"),
        )
        add = F.when(F.length(x["v"]) >= least, F.array(span)).otherwise(_no_spans())
        return F.struct(stop.alias("at"), F.concat(a["out"], add).alias("out"))

    start = F.struct(F.lit(0).alias("at"), _no_spans().alias("out"))
    found = F.aggregate(both, start, step, lambda a: a["out"])
    return F.when(text.rlike(pattern), found).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.expr(f"cast(array() as array<{_SPAN}>)")


def _random(value: Column) -> Column:
    """Whether a value looks generated: long enough, many different characters, digits, no placeholder."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 12) & (different >= 8) & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER)


def candidates(docs: DataFrame, *, id_col: str, text_col: str, owner: Column, repo: Column) -> DataFrame:
    """(rid, doc_id, text_key, owner, repo, base): one row per row of `docs`, written once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array_sort(F.concat(*[_spans_of(text, kind) for kind in KINDS]), _by_start)
    return cut(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_col).alias("doc_id"),
            F.md5(text).alias("text_key"),
            F.coalesce(owner, F.lit("")).alias("owner"),
            F.coalesce(repo, F.lit("")).alias("repo"),
            base.alias("base"),
        )
    )


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], F.sign(a["start"] - b["start"]).cast("int")).otherwise(a["rank"] - b["rank"])


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_rows) of every candidate value; combined per owner and repository
    before each exchange, so no value's rows meet in one task."""
    each = found.where(F.size("base") > 0).select("owner", "repo", F.explode(F.array_distinct("base.hash")).alias("hash"))
    return (
        each.groupBy("hash", "owner", "repo")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_rows"))
    )


def secret_scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repo: Column | None = None,
    wide: int = WIDE_OWNERS,
    wide_repos: int = WIDE_REPOS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key (MD5 of the text), spans (structs kind, start, stop,
    vstart, n_owners, n_repos in order of start and kind).

    Kinds assign, access and hex are the candidates; `live` (random-looking, of one owner and fewer than
    `wide_repos` repositories) and `example` (of `wide` owners or more, or of two or more in `wide_repos`
    repositories or more) are verdict spans over the values, once for each value's place. `owner`
    and `repo` default to the columns source, and source with lang; where a column is not there, rows do
    not differ by it. Null text counts as empty, null owners as one owner; null ids stay; repeated rows each give a row (and count as one owner); an
    empty table gives an empty one.
    """
    named = [F.col(c) for c in ("source", "lang") if c in docs.columns]
    owner = (F.col("source") if "source" in docs.columns else F.lit("")) if owner is None else owner
    repo = F.concat_ws("/", owner, *named[-1:]) if repo is None else repo
    found = candidates(docs, id_col=id_col, text_col=text_col, owner=owner, repo=repo)
    stats = cut(ownership(found))
    with_any = found.where(F.size("base") > 0).select("rid", "doc_id", "text_key", F.explode("base").alias("s"))
    judged = with_any.select("rid", "doc_id", "text_key", "s", F.col("s.hash").alias("hash")).join(
        stats.hint("merge"), "hash"
    )
    # Forks and mirrors of few owners copy too: many repositories of more than one owner are as wide.
    copied = (F.col("n_owners") >= wide) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= wide_repos))
    own = (F.col("n_owners") == 1) & (F.col("n_repos") < wide_repos)
    verdict = F.when(copied, F.lit("example")).when(own & F.col("s.random"), F.lit("live"))
    names = F.array(*map(F.lit, ORDER))

    def span(kind: Column, start: Column, rank: Column) -> Column:
        return F.struct(
            start.alias("start"),
            rank.cast("int").alias("rank"),
            kind.alias("kind"),
            F.col("s.stop").alias("stop"),
            F.col("s.vstart").alias("vstart"),
            F.col("n_owners"),
            F.col("n_repos"),
        )

    base = span(F.element_at(names, F.col("s.rank") + 1), F.col("s.start"), F.col("s.rank"))
    added = span(verdict, F.col("s.vstart"), F.when(verdict == "live", F.lit(len(KINDS))).otherwise(F.lit(len(KINDS) + 1)))
    each = judged.select("rid", "doc_id", "text_key", F.explode(F.array(base, F.when(verdict.isNotNull(), added))).alias("x"))
    gathered = each.where("x is not null").groupBy("rid", "doc_id", "text_key").agg(F.array_sort(F.collect_set("x")).alias("spans"))
    shape = gathered.schema["spans"].dataType
    rest = found.where(F.size("base") == 0).select(
        "rid", "doc_id", "text_key", F.expr("array()").cast(shape).alias("spans")
    )
    return gathered.union(rest).select("doc_id", "text_key", "spans")


def joined_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*KINDS))


def has_candidates(text: Column) -> Column:
    """Cheap superset of the texts with candidates."""
    return F.coalesce(text, F.lit("")).rlike("|".join([KINDS["assign"][0], *_FAST.values()]))


def redacted(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    mark: str = "<secret>",
    **options,
) -> DataFrame:
    """`docs` with `mark` in place of every credential value that is not a widely copied example; a
    column n_chars, if any, follows the text. All rows and columns are kept, whatever they are called;
    an empty table gives an empty one. Columns source and lang are needed only where neither `owner` nor
    `repo` is given and they exist (see secret_scan())."""
    found = secret_scan(docs, id_col=id_col, text_col=text_col, **options)
    values = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    copied = F.filter("spans", lambda s: s["kind"] == "example")
    hide = F.array_sort(
        F.transform(
            F.filter(values, lambda s: ~F.exists("copied", lambda c: (c["start"] == s["vstart"]) & (c["stop"] == s["stop"]))),
            lambda s: F.struct(s["vstart"].alias("start"), s["stop"].alias("stop")),
        )
    )
    found = (
        found.where(F.size("spans") > 0)
        .withColumn("copied", copied)
        .select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key"), hide.alias("hide"))
        .where(F.size("hide") > 0)
        .dropDuplicates(["s_id", "s_key"])
    )
    dirty = wrapped(docs.where(has_candidates(F.col(text_col))), id_col, text_col)
    met = dirty.join(found, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")), "left")
    text = F.col("row").getField(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        before = F.when(s["start"] > a["at"], F.substring(text, a["at"] + 1, s["start"] - a["at"])).otherwise(F.lit(""))
        seen = s["stop"] <= a["at"]
        return F.struct(
            F.greatest(a["at"], s["stop"]).alias("at"),
            F.when(seen | (s["start"] < a["at"]), a["out"]).otherwise(F.concat(a["out"], before, F.lit(mark))).alias("out"),
        )

    clean = F.aggregate("hide", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    met = met.withColumn("new", F.when(F.col("hide").isNull(), text).otherwise(clean))

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        if name == text_col:
            return F.col("new").alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.col("hide").isNull(), old).otherwise(F.length("new").cast(kind)).alias(name)
        return old.alias(name)

    untouched = docs.where(~has_candidates(F.col(text_col)))
    return untouched.union(met.select(*[column(c) for c in docs.columns]))
