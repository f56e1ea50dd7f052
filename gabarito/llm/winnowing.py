"""Document fingerprints by winnowing, in column expressions.

A text becomes tokens, every GRAM tokens in a row get a rolling hash, and of every WINDOW hashes
in a row the smallest is kept, of equal ones the rightmost. So two texts that share
GRAM + WINDOW - 1 tokens in a row share a print, and the kept positions say where.

A print is one long, its code: the hash in the upper half and the position, counted down, in the
lower one. The least code of a window is then its least hash at the rightmost place.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gabarito.llm.common import without
from gabarito.operators.index import dense_index
from gabarito.staging import pinned, staged

GRAM, WINDOW = 5, 8
# Rolling hash: a prime below 2^31, so that products stay within a long, and the worth of a place.
PRIME, BASE = 2_147_483_647, 1_000_003
HALF = 1 << 32
# A letter of a script written without blanks is a token, as are up to 16 other characters between blanks.
SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
TOKEN = rf"[{SCRIPTS}]|[^\s{SCRIPTS}]{{1,16}}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_hash(token: Column) -> Column:
    """28 bits of a digest that every SQL engine has."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 7), 16, 10).cast("long")


def later(xs: Column, places: int) -> Column:
    """`xs` from `places` on; all but the last ones have a partner in `xs`."""
    return F.slice(xs, F.lit(places + 1), F.greatest(F.size(xs) - places, F.lit(0)))


def grams(hashes: Column) -> Column:
    """Rolling hashes of five tokens, from those of two and four; fewer tokens are one gram."""
    square = BASE * BASE % PRIME
    roll = lambda xs, ys, worth: F.zip_with(xs, ys, lambda x, y: (x * F.lit(worth) + y) % PRIME)
    whole = let(
        roll(hashes, later(hashes, 1), BASE),
        lambda two: roll(roll(two, later(two, 2), square), later(hashes, 4), BASE),
    )
    n = F.size(hashes)
    short = F.aggregate(hashes, F.lit(0).cast("long"), lambda sum_, x: (sum_ * F.lit(BASE) + x) % PRIME)
    return F.when(n >= GRAM, F.slice(whole, F.lit(1), F.greatest(n - GRAM + 1, F.lit(0)))).when(n > 0, F.array(short)).otherwise(
        F.array().cast("array<bigint>")
    )


def least_of_windows(codes: Column) -> Column:
    """Least code of every WINDOW codes in a row, from those of two and four; fewer codes are one window."""
    pick = lambda xs, places: F.zip_with(xs, later(xs, places), lambda x, y: F.least(x, y))
    least = let(pick(codes, 1), lambda two: let(pick(two, 2), lambda four: pick(four, 4)))
    windows = F.greatest(F.size(codes) - WINDOW + 1, F.least(F.size(codes), F.lit(1)))
    return F.slice(least, F.lit(1), windows)


def prints(text: Column) -> Column:
    """Codes of the prints of a whole text, in the order of the text. A text without tokens has none."""
    coded = lambda g: F.transform(g, lambda x, i: x * HALF + (HALF - 1 - i))
    hashes = F.transform(tokens(text), token_hash)
    selected = let(hashes, lambda h: let(grams(h), lambda g: let(coded(g), least_of_windows)))
    return F.array_distinct(selected)


def hash_set(codes: Column) -> Column:
    """Distinct hashes of prints, as integers."""
    return F.array_distinct(F.transform(codes, lambda c: F.shiftright(c, 32).cast("int")))


def positions(codes: Column) -> Column:
    """Prints as `hash` and `at`, the number of the gram's first token."""
    return F.transform(codes, lambda c: F.struct(F.shiftright(c, 32).alias("hash"), (F.lit(HALF - 1) - c.bitwiseAND(HALF - 1)).alias("at")))


def written(codes: Column) -> Column:
    """Prints as text: `hash:at`, the hash in lower-case hex, parted by blanks."""
    return F.array_join(F.transform(positions(codes), lambda p: F.concat(F.lower(F.hex(p["hash"])), F.lit(":"), p["at"])), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes among all hashes of two sets; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with `prints`, array of (hash, at), of every whole text.

    Null, empty and blank texts have none. Equal texts have equal prints, repeated rows stay, an
    empty table gives no rows, and a column named `prints` gives way. Nothing is shuffled.
    """
    kept = without(df, ["prints"])
    return kept.withColumn("prints", positions(prints(F.coalesce(text_col, F.lit("")))))


def edited_by_next(df: DataFrame, row_key: list[Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against an edited form of itself and against the next document.

    The edited text is the document's own, its last quarter (rounded down) replaced by as many
    first characters of the next document, or all it has. The next document is that of the next
    row by id (null first), then by a hash of the text; after the last comes the first, and a
    single document follows itself. Rows of one id and text follow each other in the order of
    their row key. The result has the id, `n_chars`, `edited`, codes `prints` and `edited_prints`
    (see `written` and `positions`), likenesses `near_edited` and `near_next`, and `next_id`.
    Null texts are empty. An empty table gives no rows; other columns of the input play no part,
    whatever their names.

    `row_key` are expressions that tell the rows of `df` apart and stay the same when it is read
    again, such as file and row position. Without them the table is written once and its rows
    are numbered. Every exchange is on that key, so repeated ids, or texts, are spread like any
    others. Neighbours are found on narrow rows; a text is exchanged once with its prints, and
    of the next text only the borrowed characters and the print hashes travel.
    """
    own = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[k.alias(f"k{i}") for i, k in enumerate(row_key or [])])
    if row_key:
        names = [f"k{i}" for i in range(len(row_key))]
        own = own.select("id", "text", F.struct(*names).alias("key"))
    else:
        own = staged(own.withColumn("key", F.monotonically_increasing_id()), "documents")
    order = dense_index(own.select("id", F.xxhash64("text").alias("h"), F.length("text").alias("n"), "key"), [], ["id", "h", "n", "key"], "at", "rows")
    order = pinned(order.select("key", "id", "n", "at", "rows"))
    before = order.select(
        F.col("key").alias("to"),
        F.col("id").alias("to_id"),
        F.floor(F.col("n") / 4).cast("int").alias("lent"),
        ((F.col("at") + 1) % F.col("rows")).alias("at"),
    )
    links = order.select("key", F.col("id").alias("next_id"), "at").join(before, "at").drop("at")
    # Sender and receiver need the same columns of the rows, so that their exchange is one and the same.
    rows = own.select("key", "text", prints(F.col("text")).alias("prints"))
    sent = rows.join(links, "key").select(
        F.col("to").alias("key"),
        F.col("to_id").alias("id"),
        F.substring("text", F.lit(1), F.col("lent")).alias("borrowed"),
        hash_set(F.col("prints")).alias("next_set"),
        "next_id",
    )
    n = F.length("text")
    met = rows.join(sent, "key").select(
        "id",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("borrowed")).alias("edited"),
        "prints",
        "next_set",
        "next_id",
    )
    met = met.withColumn("edited_prints", prints(F.col("edited")))
    mine = hash_set(F.col("prints"))
    return met.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited",
        "prints",
        "edited_prints",
        likeness(mine, hash_set(F.col("edited_prints"))).alias("near_edited"),
        likeness(mine, F.col("next_set")).alias("near_next"),
        "next_id",
    )
