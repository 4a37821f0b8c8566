from helpers import documents  # noqa: F401
