"""Prompts meet models: packing, resolving and routing."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gabarito.functions.prompts import hosted_prompt, raw_text
from gabarito.operators.index import dense_index
from gabarito.schemas import PROMPT_MAP

# The tokenizer name of hosted models, and the two model types.
HOSTED = "api"
INSTRUCT, BASE = "instruct", "base"
# Name part of a hosted model -> its provider, first match wins.
PROVIDERS = {"gpt": "openai", "gemini": "gemini"}

Renderer = Callable[[Column], Column]


def group_models(models: list[tuple[str, str, str]]) -> dict[str, dict[str, list[str]]]:
    """Job argument [(path, tokenizer, type)] -> tokenizer -> type -> paths, order kept."""
    groups: dict[str, dict[str, list[str]]] = {}
    for path, tokenizer, kind in models:
        groups.setdefault(tokenizer, {INSTRUCT: [], BASE: []})[kind].append(path)
    return groups


def models_by_tokenizer(models: DataFrame, order: str) -> DataFrame:
    """Table form of the grouping: a model's position within its (tokenizer, type)."""
    keys = ["tokenizer_path", "model_type"]
    numbered = dense_index(models, keys, [order], "position", "n_models")
    return models.join(numbered, [*keys, order])


def split_hosted(models: DataFrame) -> DataFrame:
    """Tag every model with the backend that runs it."""
    return models.withColumn(
        "backend", F.when(F.col("tokenizer_path") == HOSTED, HOSTED).otherwise("local")
    )


def provider(path: Column) -> Column:
    """Provider of a hosted model by name; null when the name tells nothing."""
    lowered = F.lower(path)
    return F.coalesce(*[F.when(F.contains(lowered, F.lit(n)), p) for n, p in PROVIDERS.items()])


def pack_prompts(
    chat: Column,
    item: Column,
    shots: Column,
    pattern: Column,
    groups: dict[str, dict[str, list[str]]],
    structured: bool = False,
    chat_templates: dict[str, Renderer] | None = None,
    blocks: Column | None = None,
) -> Column:
    """JSON map `{tokenizer}_instruct` / `{tokenizer}_base` / `api` -> {prompt, models}.

    Instruct models need their chat template as a Column function, as no tokenizer runs here.
    `blocks` is what `hosted_prompt` takes.
    """
    templates = chat_templates or {}
    entries = []

    def entry(key: str, prompt: Column, paths: list[str]) -> None:
        cell = F.struct(prompt.alias("prompt"), F.array(*map(F.lit, paths)).alias("models"))
        entries.append(F.struct(F.lit(key).alias("key"), cell.alias("value")))

    for tokenizer, kinds in groups.items():
        if tokenizer == HOSTED:
            prompt = hosted_prompt(item, shots, pattern, structured, blocks)
            entry(tokenizer, prompt, kinds[INSTRUCT] + kinds[BASE])
            continue
        if kinds[INSTRUCT]:
            if tokenizer not in templates:
                raise ValueError(f"no chat template given for {tokenizer!r}")
            entry(f"{tokenizer}_{INSTRUCT}", templates[tokenizer](chat), kinds[INSTRUCT])
        if kinds[BASE]:
            if structured:
                raise ValueError(f"structured output needs instruct models, got base: {kinds[BASE]}")
            entry(f"{tokenizer}_{BASE}", raw_text(chat), kinds[BASE])
    return F.to_json(F.map_from_entries(F.array(*entries)))


def first_listing(entries: Column, path: Column) -> Column:
    """Prompt of the first map entry that lists the model; a model in none fails the job."""
    mine = F.filter(entries, lambda e: F.array_contains(e["value"]["models"], path))
    missing = F.raise_error(F.concat(F.lit("model not found in prompt data: "), path))
    return F.coalesce(F.get(mine, F.lit(0))["value"]["prompt"], missing)


def map_entries_of(prompt_map: Column) -> Column:
    return F.map_entries(F.from_json(prompt_map, PROMPT_MAP))


def prompt_for_model(prompt_map: Column, path: Column) -> Column:
    """A model's own text out of a packed cell."""
    return first_listing(map_entries_of(prompt_map), path)


def prompts_for_models(prompts: DataFrame, paths: list[str]) -> DataFrame:
    """Every prompt once per model of the job, as that model's own text.

    A generator over the job's model list, not a join. The cell is parsed once per prompt
    and only the wanted text travels on.
    """
    cells = prompts.withColumn("__cells", map_entries_of(F.col("prompt")))
    wanted = F.transform(
        F.array(*map(F.lit, paths)),
        lambda path: F.struct(
            path.alias("model_path"), first_listing(F.col("__cells"), path).alias("prompt")
        ),
    )
    pairs = cells.withColumn("__pair", F.explode(wanted)).drop("__cells")
    return pairs.withColumns(
        {"prompt": F.col("__pair.prompt"), "model_path": F.col("__pair.model_path")}
    ).drop("__pair")


def for_each_listed_model(prompts: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Every prompt once per model its own map lists, the text already resolved."""
    cells = F.explode(F.map_values(F.from_json(prompt, PROMPT_MAP)))
    resolved = prompts.withColumn("__cell", cells)
    return resolved.withColumn("model_path", F.explode("__cell.models")).withColumn(
        prompt, F.col("__cell.prompt")
    ).drop("__cell")
