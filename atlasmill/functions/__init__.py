"""Column functions. Those in fuzzy.py run in Arrow batches; all others stay in the JVM."""
