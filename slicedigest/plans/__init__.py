"""Laying out sheets and workbooks over bucket counts. Plan tables grow with calendar periods, never with rows."""
