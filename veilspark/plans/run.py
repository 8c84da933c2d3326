"""A whole run: read, apply techniques, search, release, write, report.

Data is read once and kept; the statistics, the histogram and the verdicts are one
aggregation each; nothing is published before the verdict on it is known.
"""
from __future__ import annotations

import json
import logging
import shutil
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.keys import KeyFolder, outside
from veilspark.operators import anonymise, bundles, documents, sheets, techniques
from veilspark.operators.policy import parse_policy
from veilspark.operators.qi import QI
from veilspark.plans import config as configuration
from veilspark.plans.config import Config
from veilspark.plans.errors import RunError
from veilspark.sources import files, postgres, sinks, tables

log = logging.getLogger("veilspark")


@dataclass(frozen=True)
class Paths:
    config: Path
    data: Path
    output: Path
    keys: Path | None = None
    root: Path = Path(".")

    @classmethod
    def under(cls, root: str | Path) -> Paths:
        r = Path(root)
        return cls(r / "config", r / "data", r / "output", None, r)

    def key_folder(self, c: Config) -> Path:
        k = self.keys or (self.root / c.key_directory if c.key_directory else self.root / "keys")
        outside(k, self.output)
        return k


@dataclass
class Input:
    df: DataFrame
    kind: str
    plan: dict | None = None


def read_input(spark: SparkSession, c: Config, paths: Paths) -> Input:
    """The input table: staged text, a data file, the database, or the one file of a folder, in this order."""
    if c.staged_input:
        file = paths.root / c.staged_input
        if not file.is_file():
            raise RunError("DATA_MISSING", "the staged input does not exist", str(file))
    elif paths.data.suffix == ".parquet" and paths.data.exists():
        return Input(tables.read_parquet(spark, files.for_tasks(spark, paths.data)), "parquet")
    elif paths.data.is_file():
        file = paths.data
    elif c.source:
        df = postgres.read(spark, c.source)
        if df.isEmpty():
            raise RunError("DB_NO_ROWS", "the input returned no rows", c.source.origin)
        return Input(df, "csv")
    else:
        file = tables.discover(paths.data)
    kind = tables.sniff(file)
    if kind == "excel":
        merged, plan = sheets.combine(tables.read_excel(spark, file), c.joins)
        return Input(merged.df, kind, plan)
    if kind == "json":
        return Input(tables.read_json(spark, file), kind)
    if kind == "csv":
        return Input(tables.read_csv(spark, file), kind)
    raise RunError("DATA_EMPTY", "the input file is empty", str(file))


def chosen(node: dict[str, int], qis: list[QI]) -> list[int]:
    """The levels of ``generalization_node``; it names every quasi-identifier and nothing else."""
    if extra := [n for n in node if n not in {q.name for q in qis}]:
        raise configuration.invalid("generalization_node names no quasi-identifier", extra[0])
    for q in qis:
        if q.name not in node:
            raise configuration.invalid("generalization_node leaves out a quasi-identifier", q.name)
        if q.kind != "uniform" and node[q.name] > q.top:
            raise configuration.invalid("a level of generalization_node is too high", f"{q.name}: {node[q.name]}, at most {q.top}")
    return [node[q.name] for q in qis]


def _grid_json(cells: list[anonymise.Cell], qis: list[QI]) -> list[dict]:
    return [
        {"k": c.k, "suppression_limit": c.sigma, "best_node": list(c.node), "generalization_node": dict(zip((q.name for q in qis), c.node)), "dm_star": c.score.dm_star,
         "num_equivalence_classes": c.score.classes, "suppression_count": c.score.suppressed, "feasible": c.feasible}
        for c in cells
    ]


def _grid_text(cells: list[anonymise.Cell]) -> str:
    head = f"{'k':>5}  {'sigma':>6}  {'best_node':24}  {'DM*':>14}  {'ECs':>6}  {'suppressed':>10}  feasible\n"
    return head + "".join(f"{c.k:>5}  {c.sigma:>6.2f}  {str(list(c.node)):24}  {c.score.dm_star:>14}  {c.score.classes:>6}  {c.score.suppressed:>10}  {'yes' if c.feasible else 'no'}\n" for c in cells)


def summary(c: Config, s: anonymise.Summary) -> dict:
    sizes = s.size_stats()
    return {
        "k": c.k, "l": c.diversity.l if c.diversity else None, "sensitive_attributes": list(c.diversity.attributes) if c.diversity else None, "t_closeness": "not implemented",
        "suppression_limit": c.sigma, "allowed_suppressions": anonymise.allowed(c.sigma, s.total_records), "total_records": s.total_records, "equivalence_classes": s.classes, "dm_star": s.dm_star,
        "class_size_min": sizes["min"], "class_size_median": sizes["median"], "class_size_mean": round(sizes["mean"], 2), "class_size_max": sizes["max"], "classes_failing_k": s.failing_k,
        "classes_failing_l": s.failing_l, "suppressed_records": s.suppressed, "published_suppressed_records": s.published_suppressed, "removed_records": s.removed,
    }


def publish(df: DataFrame, c: Config, paths: Paths, source: Input) -> dict:
    """The CSV file, the input's own format, the sheets taken apart, the database."""
    path = paths.output / c.output_path
    df = df.persist()
    if path.suffix == ".parquet":  # every partition writes its own rows; row order is not kept
        sinks.write_parquet(df, path)
    else:
        sinks.write_csv(df, path)
    out = {"final_output_path": str(path), "sample_generalized_rows": sinks.sample(df), "restored_workbook_path": None, "database_sink": None}
    if c.restore and source.plan:
        book = path.with_name(f"{path.stem}_restored.xlsx")
        try:  # an extra: the run does not fail for it
            sinks.write_workbook(sheets.restore(df, source.plan), book)
            out["restored_workbook_path"] = str(book)
        except Exception as e:
            log.warning("the restored workbook was not written: %s", type(e).__name__)
    same = sinks.write_like(df, source.kind, path.with_suffix("")) if not out["restored_workbook_path"] else None
    out["format_matched_output_path"] = str(same) if same else None
    if c.sink:
        out["database_sink"] = postgres.write(df, c.sink)
    df.unpersist()
    return out


def run_table(spark: SparkSession, c: Config, paths: Paths) -> dict:
    source = read_input(spark, c, paths)
    raw = source.df.persist()
    kept = [raw]
    try:
        return _run_table(spark, c, paths, source, raw, kept)
    finally:
        for df in kept:
            df.unpersist()


def _run_table(spark: SparkSession, c: Config, paths: Paths, source: Input, raw: DataFrame, kept: list[DataFrame]) -> dict:
    """The run over the input; what it keeps in memory is added to ``kept``."""
    keys_at = paths.key_folder(c)
    keys = KeyFolder(keys_at)
    vault = techniques.Vault(spark, keys_at / "tokens") if c.techniques.tokens else None
    counts: dict[str, int] = {}
    table = raw
    if c.run_pass != "pass1" or not c.qis:
        table = techniques.apply(raw, c.techniques, keys, vault).persist()
        kept.append(table)
        counts = techniques.counters(raw, c.techniques)
    common = {"preprocessing": counts, "chunk_count": raw.rdd.getNumPartitions()}
    if not c.qis:
        return {"pass": "preprocess_only", **common, **publish(table, c, paths, source)}
    if c.diversity and (gone := [a for a in c.diversity.attributes if a not in table.columns]):
        raise RunError("DATA_COLUMN_MISSING", "a sensitive attribute is not in the table", gone[0])
    qis, records, value_counts = anonymise.prepare(table, c.qis)
    if not records:
        raise RunError("DATA_EMPTY", "the table has no rows")
    if c.run_pass == "pass2" and c.node is not None:
        node = chosen(c.node, qis)
        return _released(c, paths, source, table, qis, node, {"pass": c.run_pass, "flow": "CHOSEN_NODE", "generalization_node": c.node, "top_ola2_nodes": [], "parameter_grid": [], **common})
    flow = anonymise.choose_flow(c.flow, records, qis)
    initial = [1] * len(qis) if flow == "direct" else anonymise.first_node(qis, c.max_classes)
    hist = anonymise.histogram_of(value_counts, qis, initial)
    values = anonymise.sensitive_values(table, qis, c.diversity.attributes, c.diversity.l).persist() if c.diversity else None
    kept += [values] if values is not None else []
    want_grid = c.run_pass != "pass2" and c.grid
    ks = sorted({*([c.k] if c.k else []), *(anonymise.GRID_K if want_grid else ())}) or [1]
    scorer = anonymise.Scorer(hist, qis, ks, values, c.diversity.l if c.diversity else 1)
    cells = anonymise.parameter_grid(scorer, initial, records) if want_grid else []
    if cells:
        (paths.output / "parameter_grid.txt").write_text(_grid_text(cells))
    if c.run_pass == "pass1":
        kept.append(scorer.hist)
        best = anonymise.k_optimal(scorer.hist, qis, c.sigma, records)
        return {"pass": "pass1", "phase": "awaiting_pass2", "k_optimal": best, "total_records": records, "suppression_limit": c.sigma, "parameter_grid": _grid_json(cells, qis), "histogram_buckets": scorer.cells, "initial_ri": list(initial)}
    found = anonymise.search(scorer, initial, c.k, c.sigma, records)
    scorer.close()
    for node, s, ok in found.trace:
        log.info("node %s: suppressed %d, DM* %d, classes %d, %s", node, s.suppressed, s.dm_star, s.classes, "pass" if ok else "fail")
    top = [{"node": list(n), "dm_star": s.dm_star, "num_equivalence_classes": s.classes, "suppression_count": s.suppressed} for n, s in found.top]
    report = {
        "pass": c.run_pass, "flow": "DIRECT_Z" if flow == "direct" else "ORIGINAL", "n_approx": records, "equivalence_space": anonymise.equivalence_space(qis), "initial_ri": list(initial),
        "lattice_size": found.lattice_size, "nodes_evaluated": len(found.trace), "top_ola2_nodes": top, "parameter_grid": _grid_json(cells, qis), **common,
    }
    out = _released(c, paths, source, table, qis, found.node, report)
    (paths.output / "top_ola2_nodes.json").write_text(json.dumps(top, indent=2))
    return out


def _released(c: Config, paths: Paths, source: Input, table: DataFrame, qis: list[QI], node, report: dict) -> dict:
    r = anonymise.release(table, qis, node, c.k, c.diversity)
    if r.summary.suppressed > anonymise.allowed(c.sigma, r.summary.total_records):
        raise RunError("SUPPRESSION_LIMIT_EXCEEDED", "the node suppresses more records than allowed", f"{r.summary.suppressed} of {r.summary.total_records}")
    out = publish(r.table, c, paths, source)
    (paths.output / "equivalence_class_stats.json").write_text(json.dumps({str(k): v for k, v in sorted(r.summary.sizes.items())}, indent=2))
    return report | {
        "output_path": c.output_path, "quasi_identifier_count": len(qis), "interval_qi_count": sum(q.kind == "interval" for q in qis), "final_rf": [int(v) for v in node], "lowest_dm_star": r.summary.dm_star,
        "num_equivalence_classes": r.summary.classes, "equivalence_class_stats": {str(k): v for k, v in sorted(r.summary.sizes.items())}, "suppressed_records": r.summary.suppressed,
        "removed_records": r.summary.removed, "total_records": r.summary.total_records, "anonymisation_summary": summary(c, r.summary), **out,
    }


def run_documents(spark: SparkSession, c: Config, paths: Paths) -> dict:
    """Nested JSON or FHIR bundles of a folder."""
    keys_at = paths.key_folder(c)
    keys = KeyFolder(keys_at)
    with files.scratch(spark) as folder:
        return _run_documents(spark, c, paths, keys_at, keys, folder)


def _run_documents(spark: SparkSession, c: Config, paths: Paths, keys_at: Path, keys: KeyFolder, scratch: str) -> dict:
    """The run over the documents; what it keeps for its steps is below ``scratch``."""
    section = c.section
    dry = bool(section.get("dry_run", False))
    at = Path(section["input_path"])
    docs = documents.read_documents(spark, str(at if at.is_absolute() else paths.root / at), f"{scratch}/in")
    if c.documents == "fhir_bundle":
        done, suffix = bundles.anonymise_bundles(docs, bundles.parse_bundle_policy(section), keys, True), "_anonymised.fhir.json"
    else:
        policy = parse_policy(section)
        vault = techniques.Vault(spark, keys_at / "tokens") if any(r.action.kind == "tokenization" for r in policy.rules) else None
        done, suffix = documents.anonymise(docs, policy, keys, vault, True, dict(section.get("key_contexts") or {}), True), ".json"
    done = files.table_at(done, f"{scratch}/done")
    total, good = done.agg(F.count("*"), F.count("document")).first()
    if not good:
        raise RunError("DATA_JSON_INVALID", "no document could be read", str(at))
    folder = paths.output / section.get("output_path", c.documents)
    written = 0 if dry else sinks.write_documents(done, folder, suffix)
    census = paths.output / f"{c.documents}_census.csv"
    sinks.write_census(documents.census_table(done), census)
    return {"flow": c.documents, "documents": total, "written": written, "failed": total - good, "dry_run": dry, "output_directory": str(folder), "census_path": str(census)}


def _remove(path: Path) -> None:
    """A file or a folder, if it is there."""
    if path.is_dir():
        shutil.rmtree(path)
    else:
        path.unlink(missing_ok=True)


def run(spark: SparkSession, paths: Paths) -> dict:
    """Run and report; ``status.json`` says how it ended, and a failed run leaves no table."""
    paths.output.mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(paths.output / "run.log", mode="w", encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.addHandler(handler)
    log.setLevel(logging.INFO)
    try:
        c = configuration.load(paths.config)
        for w in c.warnings:
            log.warning(w)
        paths.key_folder(c)
        if c.clean:
            for f in paths.output.iterdir():
                if f.name != "run.log":
                    _remove(f)
        final = paths.output / c.output_path
        if not c.documents:
            _remove(final)
        stale = sorted(f.name for f in paths.output.iterdir() if f.name not in ("run.log", "status.json"))
        if stale:
            log.warning("the output folder holds files of other runs: %s", ", ".join(stale))
        outputs = run_documents(spark, c, paths) if c.documents else run_table(spark, c, paths)
        status = {"status": "ok" if c.documents else "success", "phase": outputs.pop("phase", "done"), "outputs": outputs, "warnings": c.warnings}
    except RunError as e:
        status = e.payload()
    except Exception as e:
        text = str(e)
        code = next((x for x in ("DATA_MALFORMED_ROW", "DATA_JSON_INVALID", "FPE_VALUE_UNSUPPORTED", "FPE_DOMAIN_TOO_SMALL", "KEY_MATERIAL_INVALID", "PREPROCESSING_FAILED") if x in text), None)
        code = code or ("DATA_MALFORMED_ROW" if "MALFORMED" in text or "FAILED_READ_FILE" in text else "INTERNAL_ERROR")
        log.error("the run failed: %s", type(e).__name__)
        status = RunError(code, f"the run failed ({type(e).__name__})").payload()
    if status["status"] == "error":
        try:
            _remove(final)
        except UnboundLocalError:
            pass
    log.info("ended: %s", status["status"])
    log.removeHandler(handler)
    handler.close()
    (paths.output / "status.json").write_text(json.dumps(status, indent=2, default=str))
    return status


__all__ = ["Paths", "Input", "run", "run_table", "run_documents", "read_input"]
