"""Facts about embedding models and the prompts given to a text model."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, truncate_bytes

# Vector sizes per model name.
MODEL_DIMS = {
    "ai/embeddinggemma": 768,
    "ai/snowflake-arctic-embed": 1024,
    "ai/qwen3-embedding": 2560,
}
DEFAULT_DIMS = 768

# Fixed value: bytes of content that a model of limited input is given; callers pass
# it as ``max_bytes``.
MODEL_INPUT_BYTES = 20_000


def embedding_dims(model: Column | str) -> Column:
    pairs = [F.lit(v) for item in MODEL_DIMS.items() for v in item]
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), as_column(model)), F.lit(DEFAULT_DIMS)
    )


def model_input(content: Column | str, max_bytes: int | None) -> Column:
    """The content a model gets: all of it, or its first ``max_bytes`` bytes."""
    return as_column(content) if max_bytes is None else truncate_bytes(content, max_bytes)


def enrichment_prompts(
    title: Column | str, content: Column | str, max_bytes: int | None = None
) -> Column:
    """``struct(tags_prompt, summary_prompt)`` for one document."""
    title = as_column(title)
    body = model_input(content, max_bytes)

    def prompt(task: str) -> Column:
        return F.concat(
            F.lit(task), F.lit("\n\nTitle: "), title, F.lit("\n\n"), body
        )

    tags = prompt(
        "List 10 to 15 phrases a reader could type to find the page below, mixing "
        "its own words with other names for the same things. Answer with one line, "
        "phrases separated by commas."
    )
    summary = prompt(
        "Summarize the page below in a few plain paragraphs for a search index: its "
        "subject, the main names it mentions, the steps it describes and who it is "
        "for. Answer with the paragraphs alone."
    )
    return F.struct(tags.alias("tags_prompt"), summary.alias("summary_prompt"))
