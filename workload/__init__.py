"""The library's operators run over the driver's tables, with their SQL equivalents."""
