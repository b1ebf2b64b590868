"""Named queries by area. Importing the package registers them all."""

import importlib

AREAS = ("retail", "star", "mutations", "documents", "keyspace", "graph", "pipelines", "streams", "sinks")


def load_all() -> None:
    for area in AREAS:
        importlib.import_module(f"brindle.plans.{area}")
