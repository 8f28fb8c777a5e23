"""Operators for training data made of council records. Nothing outside this subpackage imports it."""


def registries() -> list:
    """The registries of queries of this subpackage."""
    from praktika.llm import plans

    return plans.registries()
