"""Catalogues, options and read plans; nothing here touches data."""
