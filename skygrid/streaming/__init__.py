"""skygrid.streaming"""
