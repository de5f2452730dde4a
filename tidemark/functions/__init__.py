"""Column -> Column building blocks (no Python UDFs).

scalars  tolerant text parsers: money, numbers, percents, ranges, periods,
         zoned timestamps, sentinel flags, null tokens, heading words
dates    dates and categories read from file and folder names
names    header-name rules (applied to names, or to header cells as data)
"""
