"""Queries on TESTDATA tables, one module per problem."""

import importlib

MODULES = ["sequences", "consensus", "unify", "encoding", "leaks", "names", "entities", "packing"]


def registries() -> list:
    return [importlib.import_module(f"praktika.llm.plans.{name}").registry for name in MODULES]
