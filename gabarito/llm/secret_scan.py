"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns find secrets by their form. Other long tokens of letters and digits are only
candidates: their hashes are counted over the whole corpus by distinct repository and owner.
A value that many owners hold is a copied example; one that stays with its owner looks live,
and its places are added to the spans.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gabarito.llm.arrays import bound, running
from gabarito.llm.common import unused, without
from gabarito.staging import small_join, staged

KINDS = ["assign", "access", "hex"]
ADDED = "owned"
MIN_VALUE = 6
MAX_OWNERS = 2
PLACEHOLDER = "[SECRET]"


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = (
    "(" + "|".join(map(either_case, ["password", "passwd", "secret", "token", "api_?key"])) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run of one class begins where the character before is not of it, so looking behind only saves time.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

SPAN = "struct<start:int,end:int,kind:string,place:int,hash:string>"


def spans_of(text: Column, pattern: str, kind: str, group: int = 0, fits: Callable[[Column], Column] | None = None) -> Column:
    """Spans of all leftmost non-overlapping matches in code points; `group` is the hashed value, which must fit.

    The texts between matches and the matches themselves, put end to end, give the places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole

    def placed(m: Column) -> Column:
        # The last gap has no match after it.
        steps = F.zip_with(m["gaps"], m["sizes"], lambda gap, size: gap + F.coalesce(size, F.lit(0)))

        def at(ends: Column) -> Column:
            return F.transform(
                m["values"],
                lambda v, i: F.struct((F.get(ends, i) - F.get(m["sizes"], i)).alias("start"), F.get(ends, i).alias("end"), v.alias("value")),
            )

        return bound(running(steps, lambda x, y: x + y), at)

    matches = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.transform(whole, F.length).alias("sizes"),
        value.alias("values"),
    )
    found = bound(matches, placed)
    if fits:
        found = F.filter(found, lambda s: fits(s["value"]))
    spans = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.lit([*KINDS, ADDED].index(kind)).alias("place"),
            F.sha2(s["value"], 256).alias("hash"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def apart_from(candidates: Column, base: Column) -> Column:
    """The candidates that overlap no base span: of the base spans that begin before a candidate
    ends, the farthest end lies at or before its start."""
    events = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("turn"), b["end"].alias("reach"), b.alias("span"))),
        F.transform(candidates, lambda c: F.struct(c["end"].alias("at"), F.lit(0).alias("turn"), F.lit(0).alias("reach"), c.alias("span"))),
    )

    def kept(ordered: Column) -> Column:
        far = running(F.transform(ordered, lambda e: e["reach"]), F.greatest)
        clear = lambda peaks: F.filter(
            ordered, lambda e, i: (e["turn"] == 0) & (F.get(peaks, i) <= e["span"]["start"])
        )
        return F.transform(bound(far, clear), lambda e: e["span"])

    return bound(F.array_sort(events), kept)


def scan_secrets(
    df: DataFrame,
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    keep_text: bool = True,
) -> DataFrame:
    """`df` with `spans`: array of (start, end, kind, base, n_owners, n_repositories, live).

    Spans are code points of the whole text, end exclusive, ordered by start and kind. Base
    spans are always there; `live` says whether at most `max_owners` owners hold the value
    anywhere. Spans of kind `owned` are live tokens of 20 or more letters, digits and +/_- with
    both a letter and a digit, outside the base spans. A null text is empty; null owners are
    one owner, null repositories one repository of their owner. Repeated rows stay and count
    once per repository. A column named `spans` gives way, all others stay. An empty table gives
    no rows. Work on a text grows with its finds n as n * sqrt(n).
    The finds are staged in the shared folder (this runs jobs): counting and joining then read
    them, not the texts. Hot values are counted with partial aggregation, and their join is
    broadcast when measured small, else salted.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = without(df, ["spans"])
    row, owner, repository, base, candidates, verdicts = unused(df, ["row", "owner", "repository", "base", "candidates", "verdicts"])
    by_form = F.concat(
        spans_of(text, ASSIGN, "assign", 2, lambda v: F.length(v) >= MIN_VALUE),
        spans_of(text, ACCESS, "access"),
        spans_of(text, HEX, "hex"),
    )
    tokens = spans_of(text, CANDIDATE, ADDED, fits=lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
    found = df.withColumns(
        {row: F.monotonically_increasing_id(), owner: F.col(owner_col), repository: F.col(repository_col), base: by_form}
    ).withColumn(candidates, F.when(text.rlike(CANDIDATE), apart_from(tokens, F.col(base))).otherwise(F.array().cast(f"array<{SPAN}>")))
    found = staged(found if keep_text else found.drop(text_col), "secrets")

    all_finds = F.concat(base, candidates)
    held = found.where((F.size(base) > 0) | (F.size(candidates) > 0)).select(
        F.col(row).alias("row"),
        F.col(owner).alias("owner"),
        F.col(repository).alias("repository"),
        F.posexplode(F.transform(all_finds, lambda s: s["hash"])).alias("nth", "hash"),
    )
    usage = (
        held.groupBy("hash", "owner", "repository")
        .count()
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("hash")
        .agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"))
    )
    # The verdicts of a row, in the order of its finds.
    judged_rows = (
        small_join(held.select("row", "nth", "hash"), usage, ["hash"], spread=F.xxhash64("row", "nth"))
        .groupBy(F.col("row").alias(row))
        .agg(F.array_sort(F.collect_list(F.struct("nth", "n_owners", "n_repositories"))).alias(verdicts))
    )

    def judged(s: Column, i: Column) -> Column:
        verdict = F.get(verdicts, i)
        return F.struct(
            s["start"].alias("start"),
            s["place"].alias("place"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            (s["kind"] != ADDED).alias("base"),
            verdict["n_owners"].alias("n_owners"),
            verdict["n_repositories"].alias("n_repositories"),
            (verdict["n_owners"] <= max_owners).alias("live"),
        )

    judged_spans = F.array_sort(F.filter(F.transform(all_finds, judged), lambda s: s["base"] | s["live"]))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string,base:boolean,n_owners:bigint,n_repositories:bigint,live:boolean>>")
    spans = F.when(F.col(verdicts).isNull(), none).otherwise(judged_spans)
    return found.join(judged_rows, row, "left").withColumn("spans", spans).drop(row, owner, repository, base, candidates, verdicts)


def written(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def base_spans() -> Column:
    return F.filter("spans", lambda s: s["base"])


def redacted(text_col: str = "text", placeholder: str = PLACEHOLDER) -> Column:
    """The text with every span (touching ones as one) replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] > state["at"]
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        text_so_far = F.when(
            fresh | (F.size(state["parts"]) == 0), F.concat(state["parts"], F.array(before))
        ).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), text_so_far.alias("parts"))

    start_state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate("spans", start_state, step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(F.size("spans") == 0, F.col(text_col)).otherwise(
        F.array_join(F.concat(done["parts"], F.array(rest)), placeholder)
    )
