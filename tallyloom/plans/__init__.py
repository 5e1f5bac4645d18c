"""The layers and reports, put together from the operators."""
