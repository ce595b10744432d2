"""quillsieve: a PySpark-native engine that curates conversational and instruction text.

Everything is declared with the DataFrame API; Arrow-batched Python is used only where a text automaton or a trained
model has to look at single characters.  The subpackage ``llm`` is optional: nothing outside imports it.
"""
