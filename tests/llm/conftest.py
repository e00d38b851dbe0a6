from tests.llm.cases import docs, empty  # noqa: F401
