"""Training-data operators over document tables.

Nothing outside this folder imports it; the folder can be deleted and the rest
of the library keeps working.
"""
