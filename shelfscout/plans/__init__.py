"""The four batch stages and the exploratory report, put together from the operators."""
