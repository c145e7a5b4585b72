from voltaflow.functions import constants, exprs  # noqa: F401
