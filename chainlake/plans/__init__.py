"""Reports over the stored tables, and the stand-in tables the registered queries run on."""
