"""Chat-template family detection and prompt rendering.

A template is a text with the slots ``{system}`` and ``{prompt}``, given as a Python string (one
model) or as a column (one per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import DEFAULT_SYSTEM
from pairloom.functions.text import mentions, or_default

QWEN, LLAMA, GENERIC, AUTO = "qwen", "llama", "generic", "auto"
FAMILIES = (QWEN, LLAMA)


def detect_family(template: Column) -> Column:
    """Family by the markers in a template; qwen wins if both match.

    The bracket markers count in lower case only, while the family names count in any case.
    """
    # The marker strings of each family.
    is_qwen = mentions(template, lowered=("qwen",), raw=("<|im_start|>",))
    is_llama = mentions(template, lowered=("llama",), raw=("[inst]", "<<sys>>"))
    return F.when(is_qwen, QWEN).when(is_llama, LLAMA).otherwise(GENERIC)


def render(prompt: Column, template: Column | str, system: str = DEFAULT_SYSTEM) -> Column:
    """Fill the slots. The prompt goes in last, so slot-like text inside a prompt stays as it is."""
    if "{prompt}" in system:
        raise ValueError("The system text must not hold the slot {prompt}")
    template = F.lit(template) if isinstance(template, str) else template
    with_system = F.replace(template, F.lit("{system}"), F.lit(system))
    return F.replace(with_system, F.lit("{prompt}"), prompt)


def format_prompt(
    df: DataFrame,
    family: str,
    template: Column | str | None,
    system: str = DEFAULT_SYSTEM,
    prompt: str = "prompt",
) -> DataFrame:
    """Render the prompt column for ``family``, or for the family detected per row with "auto".

    A named family must have a template. Any other name is generic: without a template its prompt
    stays unchanged.
    """
    if template is None:
        template = ""
    template = F.lit(template) if isinstance(template, str) else template
    has_template = or_default(template, "") != ""
    filled = render(F.col(prompt), template, system)
    no_template = F.raise_error(F.lit("The model family needs a chat template, and there is none"))

    if family == AUTO:
        named = detect_family(template).isin(*FAMILIES)
    else:
        named = F.lit(family in FAMILIES)
    text = F.when(has_template, filled).when(named, no_template).otherwise(F.col(prompt))
    return df.withColumn(prompt, text)
