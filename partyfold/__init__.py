"""partyfold: company / contact-person master data on PySpark.

Feeds are landed, sliced, validated, standardised, de-duplicated on
"two identifying fields equal" and upserted into two masters, all as
DataFrame plans (built-in expressions, joins, windows and aggregates).
"""

__version__ = "0.1.0"
