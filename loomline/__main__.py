"""Command line: ``generate --config FILE [--test-mode] [--steps A,B] [--sections A,B]``, ``list-steps``, ``validate-config --config FILE``, ``default-config FILE``, ``validate-dataset FILE``."""

from __future__ import annotations

import argparse
import sys

from loomline.plans.config import STEPS, create_default_config, load_config, validate_config_file


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomline")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("generate")
    run.add_argument("--config", required=True)
    run.add_argument("--test-mode", action="store_true")
    run.add_argument("--steps")
    run.add_argument("--sections")
    commands.add_parser("list-steps")
    check = commands.add_parser("validate-config")
    check.add_argument("--config", required=True)
    commands.add_parser("default-config").add_argument("path")
    commands.add_parser("validate-dataset").add_argument("path")
    got = parser.parse_args(args)
    if got.command == "list-steps":
        print(*STEPS, sep="\n")
        return 0
    if got.command == "default-config":
        create_default_config(got.path)
        return 0
    if got.command == "validate-dataset":
        from loomline.plans.session import session
        from loomline.sources.files import validate_file

        sound, found = validate_file(session(), got.path)
        for name, table in found.items():
            print(name)
            table.show(20, truncate=80)
        return 0 if sound else 1
    if found := validate_config_file(got.config):
        print(*found, sep="\n", file=sys.stderr)
        return 1
    if got.command == "validate-config":
        print("ok")
        return 0
    from loomline.plans.logs import create_logger
    from loomline.plans.session import session
    from loomline.plans.steps import run_steps, write_outputs

    config = load_config(got.config)
    create_logger(log_level="DEBUG" if config.verbose else config.log_level, log_file=config.log_file)
    config.test_mode = config.test_mode or got.test_mode
    config.steps = got.steps.split(",") if got.steps else config.steps
    print(*write_outputs(run_steps(session(), config, got.sections.split(",") if got.sections else None)), sep="\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())
