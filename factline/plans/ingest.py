"""Documents in, published and checked tables out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions.canonical import canonical
from factline.operators import checks
from factline.operators.compare import duplicate_keys
from factline.operators.code import code_digest, identity, library_digest
from factline.operators.versions import recipe_hash, table_digest
from factline.sources import artifacts
from factline.storage import keep

Step = str | Callable[[SparkSession, dict], DataFrame]


@dataclass(frozen=True)
class PipelineSpec:
    """Ordered steps, each naming the table it makes.

    A step is a query that writes table names as `{table}`, or a function of the session and
    the tables made so far. `outputs` maps published names to tables; `functions` maps the
    name of a SQL function to a Python function and its return type.
    """

    id: str
    version: str
    steps: list[tuple[str, Step]]
    outputs: dict[str, str]
    params: tuple[str, ...] = ()
    functions: dict[str, tuple] = field(default_factory=dict)

    def digest(self) -> str:
        """Identity of the pipeline: every query, and all code and bound values that steps and functions reach."""
        described = [[name, step if isinstance(step, str) else identity(step)] for name, step in self.steps]
        named = [[name, identity(function), str(returns)] for name, (function, returns) in sorted(self.functions.items())]
        return code_digest(canonical([self.id, self.version, described, named, self.outputs, list(self.params)]))


def params_table(spark: SparkSession, params: dict) -> DataFrame:
    return spark.createDataFrame([(k, canonical(v)) for k, v in params.items()], "name string, value_json string")


def run(
    spark: SparkSession,
    spec: PipelineSpec,
    inputs: dict[str, DataFrame],
    params: dict,
    root: str,
    scope: str,
    asset_table: str = "input_files",
    input_digests: dict[str, str] | None = None,
) -> dict:
    """Run a declared pipeline, or return the artifact of an equal earlier run.

    A run sees only the tables handed to it and those its own steps make. Input digests are
    computed here unless the caller already has them for this version of the tables. Its SQL
    functions are known for the time of the run only, and must not take a name that exists.
    """
    unknown = set(params) - set(spec.params)
    if unknown:
        raise ValueError(f"undeclared parameters: {sorted(unknown)}")
    digests = input_digests or {name: table_digest(df)[1] for name, df in inputs.items()}
    recipe = {"scope_id": scope, "input_tables": digests, "package_digest": spec.digest(), "pipeline": spec.id,
              "params": params, "versions": {"spark": pyspark.__version__, "library": library_digest()}}
    key = recipe_hash(recipe)
    earlier = artifacts.find(spark, root, key)
    if earlier:
        return {"tables": artifacts.load(spark, root, earlier, scope), "artifact_id": earlier,
                "recipe_hash": key, "reused": True}
    taken = [name for name in spec.functions if spark.catalog.functionExists(name)]
    if taken:
        raise ValueError(f"functions of that name exist in the session: {sorted(taken)}")
    try:
        for name, (function, returns) in spec.functions.items():
            spark.udf.register(name, F.udf(function, returns, useArrow=True))
        manifest = _published(spark, spec, inputs, params, root, scope, asset_table, recipe, key)
    finally:  # all outputs are written by now; the names are free for other runs
        for name in spec.functions:
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS `{name}`")
    return {"tables": artifacts.tables_of(spark, root, manifest),
            "artifact_id": manifest["artifact_id"], "recipe_hash": key, "reused": False}


def _published(spark: SparkSession, spec: PipelineSpec, inputs: dict, params: dict, root: str, scope: str, asset_table: str, recipe: dict,
               key: str) -> dict:
    """Run the steps and publish what they made; gives the manifest."""
    tables = {**inputs, "run_params": params_table(spark, params)}
    if asset_table in inputs:
        # Stored: read by steps and checks, and joined by its real size, which hashes as ids make far larger than Spark's guess.
        tables[asset_table] = keep(inputs[asset_table], "assets")
    for name, step in spec.steps:
        tables[name] = sql_step(spark, step, tables) if isinstance(step, str) else step(spark, tables)
    outputs = {logical: tables[name] for logical, name in spec.outputs.items()}
    for logical, df in outputs.items():
        problems = checks.fixed_schema(df.schema, logical)
        if problems:
            raise checks.ContractError(f"{logical}: {problems}")

    def check(written: dict[str, DataFrame]) -> None:
        if "evidence" in written and asset_table in tables:
            checks.require_none(duplicate_keys(tables[asset_table], ["asset_id"]), "asset ids")
            checks.require_none(checks.check_evidence(written["evidence"], tables[asset_table]), "evidence")

    return artifacts.publish(spark, outputs, root, scope, recipe, key,
                             {"id": spec.id, "version": spec.version, "digest": spec.digest()}, check=check)


def sql_step(spark: SparkSession, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a query that names tables as `{table}`. No shared view name is taken."""
    used = {name: df for name, df in tables.items() if "{" + name + "}" in query}
    return spark.sql(query, **used)
