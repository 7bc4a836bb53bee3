"""barforge: a Spark-native market-feature, signal and back-test library.

Every operator is a function from DataFrame(s) to DataFrame; nothing runs an
action except the explicit materialisation helpers in ``barforge.plans``.
"""

__version__ = "0.1.0"
