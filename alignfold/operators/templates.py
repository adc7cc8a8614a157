"""Conversation templates: registry lookup (P13) and rendering (P12), as array expressions.

A template is split once on the driver into (prefix, suffix) around ``{query}``;
rendering is then ``concat`` inside ``transform`` - no Python per row, and braces
inside user text are never parsed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.template_registry import REGISTRATIONS
from alignfold.functions.text import col_of, sql_str

DEFAULT_TEMPLATE = "vicuna"


@dataclass(frozen=True)
class Template:
    name: str
    system_prompt: str
    roles: tuple
    prompt: str
    sep: str
    stop_str: str = "</s>"

    @property
    def prefix(self) -> str:
        return self.prompt.split("{query}", 1)[0]

    @property
    def suffix(self) -> str:
        parts = self.prompt.split("{query}", 1)
        return parts[1] if len(parts) > 1 else ""


def _registry() -> dict:
    reg: dict = {}
    for name, system, roles, prompt, sep, stop in REGISTRATIONS:
        reg[name] = Template(name, system, tuple(roles), prompt, sep, stop)  # later registration wins
    return reg


TEMPLATES = _registry()


def get_template(name: str) -> Template:
    if name not in TEMPLATES:
        raise KeyError(f"unknown template {name!r}; known: {sorted(TEMPLATES)}")
    return TEMPLATES[name]


def register_template(t: Template) -> None:
    TEMPLATES[t.name] = t


def templates_df(spark: SparkSession) -> DataFrame:
    """The registry as a 29-row dimension table (fixed size: always safe to broadcast)."""
    rows = [(t.name, t.system_prompt, t.prefix, t.suffix, t.sep, t.stop_str) for t in TEMPLATES.values()]
    schema = "template string, t_system string, t_prefix string, t_suffix string, t_sep string, t_stop string"
    return spark.createDataFrame(rows, schema)


def _parts(template):
    """Columns (system, prefix, suffix, sep) from a Template or from t_* columns of a joined row."""
    if isinstance(template, Template):
        return F.lit(template.system_prompt), F.lit(template.prefix), F.lit(template.suffix), F.lit(template.sep)
    return F.col("t_system"), F.col("t_prefix"), F.col("t_suffix"), F.col("t_sep")


def render_dialog(pairs, system, template) -> Column:
    """``get_dialog``: [q0', a0, q1', a1, ...] with q0' = sys+sep + prefix+q0+suffix, qk' = sep + prefix+qk+suffix.

    ``pairs`` is array<struct<query, answer>>; ``system`` overrides the template's
    system prompt when non-empty. Null or empty pairs render to an empty array.
    """
    t_sys, pre, suf, sep = _parts(template)
    sys = t_sys if system is None else F.coalesce(F.nullif(col_of(system), F.lit("")), t_sys)
    sys_sep = F.when(F.coalesce(sys, F.lit("")) != "", F.concat(sys, sep)).otherwise(F.lit(""))
    p = F.coalesce(col_of(pairs), F.array().cast(T.ArrayType(T.StructType([
        T.StructField("query", T.StringType()), T.StructField("answer", T.StringType())]))))
    return F.flatten(F.transform(p, lambda x, i: F.array(
        F.concat(F.when(i == 0, sys_sep).otherwise(sep), pre, F.coalesce(x["query"], F.lit("")), suf),
        F.coalesce(x["answer"], F.lit("")))))


def render_prompt(pairs, system, template) -> Column:
    """``get_prompt``: the dialog joined into one string, answers included."""
    return F.array_join(render_dialog(pairs, system, template), "")


def render_dialog_sql(pairs: str, system: str | None, t: Template) -> str:
    sys = f"coalesce(nullif({system}, ''), {sql_str(t.system_prompt)})" if system else sql_str(t.system_prompt)
    sys_sep = f"(CASE WHEN coalesce({sys}, '') <> '' THEN {sys} || {sql_str(t.sep)} ELSE '' END)"
    return (f"flatten(list_transform(generate_series(1, len(coalesce({pairs}, []))), lambda i: ["
            f"(CASE WHEN i = 1 THEN {sys_sep} ELSE {sql_str(t.sep)} END) || {sql_str(t.prefix)} || "
            f"coalesce(({pairs})[i].query, '') || {sql_str(t.suffix)}, coalesce(({pairs})[i].answer, '')]))")


def render_prompt_sql(pairs: str, system: str | None, t: Template) -> str:
    return f"array_to_string({render_dialog_sql(pairs, system, t)}, '')"


def with_template(df: DataFrame, template_col: str = "template") -> DataFrame:
    """Attach t_* columns for a per-row template name (broadcast of the fixed 29-row registry)."""
    return df.join(F.broadcast(templates_df(df.sparkSession)), template_col, "left")
