"""A task workspace: load, describe, execute, read, checkpoint and restore."""

from __future__ import annotations

import functools
import inspect
import re
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions import text
from factline.functions.canonical import canonical, digest
from factline.operators import chunks, lineage
from factline.operators.checks import check_manifests, require_none, verify_files
from factline.operators.versions import code_digest, table_digest
from factline.plans import checkpoints, ingest, oplog
from factline.plans.results import StoredResult, preview, store_result
from factline.sources import artifacts, database, files, knowledge
from factline.storage import keep


class Workspace:
    """Named tables, stored results and a log under one folder.

    Tables are DataFrames; nothing is counted or copied to the driver to register one.
    """

    def __init__(self, spark: SparkSession, root: str, scope: str = "local"):
        self.spark, self.root, self.scope = spark, root.rstrip("/"), scope
        self.tables: dict[str, DataFrame] = {}
        self.provenance: dict[str, dict] = {}
        self.assets: DataFrame | None = None
        self.sources: list[tuple[str, str | None]] = []
        self.seen: DataFrame | None = None
        self.copies: DataFrame | None = None
        self.results: dict[str, StoredResult] = {}
        self._versions: dict[str, str] = {}
        self._digests: dict[str, str] = {}
        self.functions: dict[str, dict] = {}

    @contextmanager
    def _logged(self, action: str, request: dict):
        entry = {"operation_id": str(uuid4()), "action": action, "request": text.redact_text(canonical(request), text.known_secrets()),
                 "request_digest": digest(request), "input_tables": dict(self._versions), "started_at": artifacts.now(),
                 "status": "succeeded"}
        before, versions = dict(self.tables), dict(self._versions)
        try:
            yield entry
            self._trace(entry, {name for name, version in self._versions.items() if versions.get(name) != version})
        except BaseException:
            entry["status"] = "failed"
            for name in self.tables.keys() - before.keys():
                self.spark.catalog.dropTempView(name)
            for name, df in before.items():
                if self.tables.get(name) is not df:
                    df.createOrReplaceTempView(name)
            self.tables = before
            raise
        finally:
            for key in ("reads", "files", "makes", "edges"):  # kept as edges, not in the log
                entry.pop(key, None)
            entry["finished_at"] = artifacts.now()
            entry["output_tables"] = sorted(name for name, df in self.tables.items() if before.get(name) is not df)
            oplog.append(self.spark, f"{self.root}/log", entry)

    def _node(self, name: str) -> str:
        return f"table:{name}@{self._versions[name]}"

    def _trace(self, entry: dict, made: set[str]) -> None:
        """Record what a finished operation read and made.

        An operation may set `reads` and `makes` (nodes), `files` (a table of assets it read) and
        `edges` (pairs that do not lead through the operation).
        """
        operation = f"operation:{entry['operation_id']}"
        direct = entry.get("edges", [])
        targets = {self._node(name) for name in made} - {target for _, target in direct}
        pairs = [*direct, *[(node, operation) for node in entry.get("reads", [])],
                 *[(operation, node) for node in [*entry.get("makes", []), *sorted(targets)]]]
        edges = self.spark.createDataFrame(pairs, lineage.EDGES).coalesce(1)
        if entry.get("files") is not None:
            edges = edges.unionByName(entry["files"].select(
                F.concat(F.lit("asset:"), "asset_id").alias("source"), F.lit(operation).alias("target")))
        lineage.record(edges, f"{self.root}/lineage", entry["operation_id"])

    def add(self, name: str, df: DataFrame, provenance: dict | None = None) -> DataFrame:
        """Register a table and make it visible to SQL."""
        if not name.isidentifier():
            raise ValueError("a table name has letters, digits and underscores")
        df.createOrReplaceTempView(name)
        self.tables[name], self.provenance[name] = df, provenance or {"kind": "python"}
        self._versions[name] = str(uuid4())
        return df

    def digest(self, name: str) -> str:
        """Content digest of a table, computed once for each version of it."""
        version = self._versions[name]
        if version not in self._digests:
            self._digests[version] = table_digest(self.tables[name])[1]
        return self._digests[version]

    def changed_sources(self) -> DataFrame:
        """Loaded files that are gone or no longer have the bytes they were loaded with.

        Files whose length and time are those of the load are not read again.
        """
        found = []
        if self.seen is not None:
            listed = [files.list_files(self.spark, path, glob) for path, glob in self.sources]
            again = files.rescan(self.spark, self.seen, functools.reduce(DataFrame.unionByName, listed).distinct())
            found.append(again.filter(F.col("status") != "gone").select("path", "sha256"))
        if self.copies is not None:  # of a restored checkpoint: their bytes, not the files they came from
            found.append(self.copies.select("path", F.sha2("content", 256).alias("sha256")))
        now = functools.reduce(DataFrame.unionByName, found).distinct()
        return verify_files(self.assets, now).filter(F.col("status").isin("missing", "mismatch"))

    # Load

    def load_file(self, path: str, name: str | None = None, glob: str | None = None, schema=None) -> DataFrame:
        """Register files as assets; tabular files also become a table when a name is given."""
        with self._logged("load", {"kind": "file", "path": path, "name": name}) as entry:
            seen = keep(files.file_digests(self.spark, path, glob), "assets")
            self.sources.append((path, glob))
            self.seen = seen if self.seen is None else self.seen.unionByName(seen).dropDuplicates(["path", "sha256"])
            found = files.as_assets(seen.drop("modified"))
            entry["files"] = found
            self.assets = found if self.assets is None else self.assets.unionByName(found).dropDuplicates(["asset_id"])
            if name is None:
                return found
            return self.add(name, files.load_table(self.spark, path, schema=schema), {"kind": "file", "path": path})

    def load_database(self, name: str, url: str, query: str, **options) -> DataFrame:
        with self._logged("load", {"kind": "database", "query": query}) as entry:
            entry["reads"] = [f"query:{code_digest(query)}"]
            result = keep(database.load_query(self.spark, url, query, **options), name)
            return self.add(name, result, {"kind": "database", "query": query, "read_only": True})

    def load_knowledge(self, prefix: str, documents_path: str, pages_path: str, allowed_bases: list[str],
                       requested: DataFrame | None = None, label: str = "ARTIFACT") -> dict[str, DataFrame]:
        """Documents, their chunks, completeness, and the status of the artifacts they name."""
        with self._logged("load", {"kind": "knowledge", "pages": pages_path}) as entry:
            entry["reads"] = [f"file:{documents_path}", f"file:{pages_path}"]
            documents = knowledge.load_documents(self.spark, documents_path, allowed_bases)
            pages = keep(knowledge.load_envelopes(self.spark, pages_path).join(
                documents.select("knowledge_id"), "knowledge_id", "left_semi"), "envelopes")
            bad = chunks.bad_envelopes(pages).take(1)
            if bad:
                raise ValueError(f"response invalid: {bad[0].asDict()}")
            if requested is not None:
                gone = keep(chunks.missing(pages, requested), "missing-chunks")
                if n := gone.count():
                    raise ValueError(f"chunks not found: {n}, listed in {gone.inputFiles()[0].rsplit('/', 1)[0]}")
            kept = keep(chunks.assemble(pages, requested), "chunks")
            manifests = check_manifests(artifacts.manifests(self.spark, self.root), self.scope, artifacts.SCHEMA_VERSION)
            index = manifests.select(F.col("folder").alias("artifact_id"), F.lit("workspace").alias("store_alias"),
                                     F.nullif("status", F.lit("ok")).alias("problem"))
            made = {
                f"{prefix}_documents": documents,
                f"{prefix}_chunks": kept,
                f"{prefix}_completeness": chunks.completeness(pages),
                f"{prefix}_artifacts": chunks.marker_status(documents, chunks.markers(kept, label), index),
            }
            for name, df in made.items():
                self.add(name, df, {"kind": "knowledge", "pages": pages_path})
            return made

    def load_marked(self, prefix: str) -> list[str]:
        """Load every artifact that the chunks of a knowledge load name and that may be loaded."""
        usable = self.tables[f"{prefix}_artifacts"].filter(F.col("status") == "loaded").select("artifact_id").distinct()
        ids = [r["artifact_id"] for r in usable.collect()]
        for artifact_id in ids:
            self.load_artifact("artifact_" + artifact_id.replace("-", ""), artifact_id)
        return ids

    def load_artifact(self, prefix: str, artifact_id: str) -> dict[str, DataFrame]:
        with self._logged("load", {"kind": "artifact", "artifact_id": artifact_id}) as entry:
            entry["reads"] = [f"artifact:{artifact_id}"]
            made = artifacts.load(self.spark, self.root, artifact_id, self.scope)
            return {f"{prefix}_{name}": self.add(f"{prefix}_{name}", df, {"kind": "artifact", "artifact_id": artifact_id})
                    for name, df in made.items()}

    # Describe

    def catalog(self) -> DataFrame:
        """One row per table: name, columns and where it came from."""
        rows = [(name, [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields], str(self.provenance[name]["kind"]))
                for name, df in sorted(self.tables.items())]
        return self.spark.createDataFrame(rows, "name string, columns array<string>, kind string")

    def describe(self, name: str) -> dict:
        return {"name": name, **preview(self.tables[name]), "provenance": self.provenance[name]}

    def describe_functions(self) -> list[dict]:
        return [{"name": n, **f} for n, f in sorted(self.functions.items())]

    def operations(self, n: int = 20) -> DataFrame:
        return oplog.last_operations(oplog.read(self.spark, f"{self.root}/log"), n=n)

    def depends_on(self, nodes: list[str], up: bool = False) -> DataFrame:
        """What rests on the given nodes, in this workspace and in those before it under the same folder.

        Nodes are `asset:<id>`, `table:<name>` (as it is now), `table:<name>@<version>`, `result:<id>`, `artifact:<id>`,
        `checkpoint:<id>/<table>`, `operation:<id>`; with `up`, what the nodes rest on.
        """
        now = {f"table:{name}": self._node(name) for name in self.tables}
        starts = self.spark.createDataFrame([(now.get(node, node),) for node in nodes], "node string")
        return lineage.reach(lineage.recorded(self.spark, f"{self.root}/lineage"), starts, up)

    # Execute

    def register(self, name: str, function: Callable, parameters: list[str], returns: str) -> None:
        """Make a scalar Python function callable from SQL; values cross in Arrow batches."""
        if name in self.functions:
            raise ValueError(f"function {name} exists")
        if len(inspect.signature(function).parameters) != len(parameters):
            raise ValueError("one type per parameter is needed")
        self.spark.udf.register(name, F.udf(function, returns, useArrow=True))
        self.functions[name] = {"parameters": parameters, "return_type": returns}

    def sql(self, query: str, args: list | dict | None = None, name: str | None = None) -> str:
        """Run one statement with bound values, store its result for paging, and give its id."""
        with self._logged("execute", {"mode": "sql", "sql": query, "bindings": args or []}) as entry:
            result = store_result(self.spark.sql(query, args=args), path=f"{self.root}/results/{entry['operation_id']}")
            self.results[entry["operation_id"]] = result
            # Every word of the statement that is a table's name, so that no table it reads is missed.
            words = {word.lower() for word in re.findall(r"\w+", query)}
            entry["reads"] = [self._node(table) for table in self.tables if table.lower() in words]
            entry["makes"] = [f"result:{entry['operation_id']}"]
            if name:
                self.add(name, result.table(), {"kind": "sql", "code_digest": code_digest(query)})
            return entry["operation_id"]

    def python(self, step: Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]) -> list[str]:
        """Run a step over the tables; the tables it returns are published."""
        with self._logged("execute", {"mode": "python", "step": step.__qualname__}) as entry:
            entry["reads"] = [self._node(name) for name in self.tables]
            made = step(self.spark, dict(self.tables))
            for name, df in made.items():
                self.add(name, df, {"kind": "python", "step": step.__qualname__})
            return list(made)

    def pipeline(self, spec: ingest.PipelineSpec, inputs: list[str], params: dict | None = None) -> dict[str, Any]:
        """Run a declared pipeline. Every distinct run adds its own tables and leaves older ones."""
        with self._logged("execute", {"mode": "pipeline", "id": spec.id, "params": params or {}}) as entry:
            taken = {name: self.tables[name] for name in inputs}
            entry["reads"] = [self._node(name) for name in inputs]
            digests = {name: self.digest(name) for name in inputs}
            if self.assets is not None and "input_files" not in taken:
                require_none(self.changed_sources(), "source changed")
                taken["input_files"] = entry["files"] = self.assets
                digests["input_files"] = table_digest(self.assets)[1]
            result = ingest.run(self.spark, spec, taken, params or {}, self.root, self.scope, input_digests=digests)
            entry["makes"] = [f"artifact:{result['artifact_id']}"]
            prefix = "run_" + result["artifact_id"].replace("-", "")
            for name, df in result["tables"].items():
                self.add(f"{prefix}_{name}", df, {"kind": "pipeline", "id": spec.id, "recipe_hash": result["recipe_hash"]})
            return {**result, "prefix": prefix}

    def read(self, result_id: str, offset: int = 0, limit: int = 20) -> dict:
        return self.results[result_id].read(offset, limit)

    # Checkpoints

    def checkpoint(self, names: list[str], after: str | None = None, keys: dict[str, list[str]] | None = None) -> str:
        """Save tables and loaded files. With `after`, an earlier checkpoint, or `keys`, the key columns of tables, rows are
        saved in buckets, and buckets that `after` already holds are not written again."""
        if len(set(names)) != len(names):
            raise ValueError("name each table once")
        with self._logged("checkpoint", {"tables": names}) as entry:
            copies = self.copies
            if self.assets is not None:
                require_none(self.changed_sources(), "source changed")
                for path, glob in self.sources:
                    found = files.scan_assets(self.spark, path, glob, content=True)
                    copies = found if copies is None else copies.unionByName(found)
                copies = copies.dropDuplicates(["asset_id"])
            chosen, known = {n: self.tables[n] for n in names}, {n: self.provenance[n] for n in names}
            if after is None and keys is None:
                saved = checkpoints.save(self.spark, chosen, self.root, self.scope, known, copies)
            else:
                files_too = {} if copies is None else {checkpoints.ASSETS: copies}
                saved = checkpoints.save_changed(self.spark, {**chosen, **files_too}, self.root, self.scope, after,
                                                 {**(keys or {}), checkpoints.ASSETS: ["asset_id"]}, provenance=known)
            entry["edges"] = [(self._node(n), f"checkpoint:{saved}/{n}") for n in names]
            return saved

    def restore(self, checkpoint_id: str) -> list[str]:
        with self._logged("restore", {"checkpoint_id": checkpoint_id}) as entry:
            made = checkpoints.restore(self.spark, self.root, checkpoint_id, self.scope)
            copies = made.pop(checkpoints.ASSETS, None)
            if copies is not None:
                self.assets, self.copies, self.sources, self.seen = copies.drop("content"), copies, [], None
            for name, df in made.items():
                self.add(name, df, {"kind": "checkpoint", "checkpoint_id": checkpoint_id})
            entry["edges"] = [(f"checkpoint:{checkpoint_id}/{name}", self._node(name)) for name in made]
            return list(made)

