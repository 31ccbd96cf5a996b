"""The steps on the command line: python -m tidelake.cli extract | detide | daily-max | monthly-max | skill."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidelake.functions import calendars as C
from tidelake.plans import steps
from tidelake.schema import INDEX_SCHEMES, VARIABLES
from tidelake.session import session

#: Fields of the file names, which an option, then the YAML file, then the input gives.
NAMING = ("group_name", "climate_forcing", "scenario", "location")


def parser() -> argparse.ArgumentParser:
    """A command for each step; its options are the step's parameters."""
    top = argparse.ArgumentParser(prog="tidelake", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, says: str, convention: bool = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=says, description=says)
        p.add_argument("--output-dir", required=True, help="folder of the results")
        p.add_argument("--force", action="store_true", help="write again what is there")
        p.add_argument("--metadata-yaml", dest="yaml_path", help="fields of the metadata, over those of the input")
        for f in NAMING:
            p.add_argument(f"--{f.replace('_', '-')}", help=f"the file names' {f}, over the YAML file's")
        if convention:
            p.add_argument("--time-stamp-convention", choices=sorted(C.CONVENTIONS), help="whether a stamp is an instant or the end of an interval")
        return p

    p = command("extract", "hourly water levels at the mesh nodes nearest to given points")
    p.add_argument("--points-csv", required=True, help="points, with columns longitude and latitude")
    p.add_argument("--mesh", required=True, help="table of the mesh: node_index, lon, lat, depth")
    p.add_argument("--mesh-series", required=True, help="table of its series: node_index, file_year, time_h, value")
    p.add_argument("--start-date", help="first instant, inclusive")
    p.add_argument("--end-date", help="last instant, inclusive")
    p.add_argument("--yearly-files", action="store_true", help="files hold a year each: those of other years aren't opened")
    p.add_argument("--wet-mask", help="table of node_index, always_wet: only nodes that never fall dry are matched")
    p.add_argument("--model-name", choices=sorted(INDEX_SCHEMES), help="the model whose numbering the stored node block follows")
    p.add_argument("--calendar", help="the series' calendar, standard by default")
    p.add_argument("--mesh-index", help="where the mesh's index is kept, built if it isn't there")
    p = command("detide", "hourly storm surge: water levels less their tide", convention=False)
    p.add_argument("--hourly", required=True, help="table of hourly water levels")
    p.add_argument("--state-dir", help="where sums are kept by file, so that a stopped run goes on")
    p.add_argument("--per-node-mask", action="store_true", help="fit each node to its own valid hours")
    p.add_argument("--allow-rank-deficient", action="store_true", help="fit a record that is too short for its constituents")
    for name, says in (("daily-max", "daily maxima"), ("monthly-max", "monthly maxima, a day apart at least")):
        p = command(name, says)
        p.add_argument("--hourly", required=True, help="table of an hourly series")
        p.add_argument("--variable", required=True, choices=sorted(VARIABLES), help="what the series holds")
    p = commands.add_parser("skill", help="scores of a model against tide gauges")
    for name, says in (("gauges", "folder of gauge files"), ("mesh", "table of the mesh"), ("mesh-series", "table of its series"), ("output", "table of the scores")):
        p.add_argument(f"--{name}", required=True, help=says)
    for name, says in (("start-date", "first instant"), ("end-date", "last instant"), ("mesh-index", "where the mesh's index is kept")):
        p.add_argument(f"--{name}", help=says)
    p.add_argument("--max-km", type=float, default=50.0, help="gauges without a node within so many km are left out")
    p.add_argument("--force", action="store_true", help="write again what is there")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """The command's step; the path of its result."""
    if args.command == "skill":
        return steps.skill(spark, args.gauges, args.mesh, args.mesh_series, args.output, args.start_date, args.end_date, args.max_km, args.mesh_index, args.force)
    fields = {f: getattr(args, f, None) for f in (*NAMING, "time_stamp_convention")}
    more = {"force": args.force, "yaml_path": args.yaml_path} | {k: v for k, v in fields.items() if v is not None}
    if args.command == "extract":
        return steps.extract(spark, args.points_csv, args.mesh, args.mesh_series, args.output_dir, args.wet_mask, args.start_date, args.end_date, args.calendar, model_name=args.model_name, index_path=args.mesh_index, yearly=args.yearly_files, **more)
    if args.command == "detide":
        return steps.detide(spark, args.hourly, args.output_dir, allow_rank_deficient=args.allow_rank_deficient, per_node_mask=args.per_node_mask, state_dir=args.state_dir, **more)
    step = steps.daily_max if args.command == "daily-max" else steps.monthly_max
    return step(spark, args.hourly, args.variable, args.output_dir, **more)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    print(run(session(f"tidelake {args.command}"), args))


if __name__ == "__main__":
    main()
